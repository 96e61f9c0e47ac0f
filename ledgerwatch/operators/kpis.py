"""Dashboard figures over the gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import VELOCITY_PREFIX, pseudonymize_iban
from ledgerwatch.operators.marts import ROLLING
from ledgerwatch.operators.upserts import apply_block_decisions


def _is_blocked(status: str = "final_status") -> Column:
    return F.col(status) == "BLOCKED"


def _share(part: Column, whole: Column) -> Column:
    """Ratio as a double, NULL for an empty whole."""
    return F.try_divide(part, whole)


def kpi_totals(facts: DataFrame) -> DataFrame:
    """Transactions processed, how many were flagged, and the fraud rate."""
    counted = facts.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if(_is_blocked()).alias("flagged_transactions"),
    )
    rate = _share(F.col("flagged_transactions"), F.col("total_transactions"))
    return counted.withColumn("fraud_rate", rate)


def kpi_customers_by_tier(customers: DataFrame) -> DataFrame:
    return customers.groupBy("risk_tier").agg(F.count(F.lit(1)).alias("customers"))


def kpi_reconciliation(facts: DataFrame) -> DataFrame:
    """Number and share of transactions per final status."""
    counts = facts.groupBy("final_status").agg(F.count(F.lit(1)).alias("transactions"))
    # The window sees one row per status.
    total = F.sum("transactions").over(W.partitionBy())
    return counts.withColumn("share", _share(F.col("transactions"), total))


def kpi_fraud_breakdown(facts: DataFrame) -> DataFrame:
    """Transactions, blocked ones and rate by tier, by channel and by both.

    Facts are reduced to one row per tier and channel before the grouping sets,
    which would otherwise triple every fact.
    """
    cells = facts.groupBy("risk_tier", "payment_channel").agg(
        F.count(F.lit(1)).alias("_all"), F.count_if(_is_blocked()).alias("_bad")
    )
    tier, channel = F.col("risk_tier"), F.col("payment_channel")
    sets = [[tier], [channel], [tier, channel]]
    totals = cells.groupingSets(sets, tier, channel).agg(
        F.grouping("risk_tier").cast("int").alias("_tier_rolled"),
        F.grouping("payment_channel").cast("int").alias("_channel_rolled"),
        F.sum("_all").alias("transactions"),
        F.sum("_bad").alias("blocked"),
    )
    breakdown = (
        F.when(F.col("_channel_rolled") == 1, "risk_tier")
        .when(F.col("_tier_rolled") == 1, "payment_channel")
        .otherwise("risk_tier+payment_channel")
    )
    return totals.select(
        breakdown.alias("breakdown"),
        "risk_tier",
        "payment_channel",
        "transactions",
        "blocked",
        _share(F.col("blocked"), F.col("transactions")).alias("fraud_rate"),
    )


def alert_listing(alerts: DataFrame, key: str | None = None) -> DataFrame:
    """Alerts as the dashboard lists them, largest sum first.

    With a ``key`` the customer id is replaced by its keyed hash.
    """
    customer = F.col("customer_id")
    return alerts.select(
        "rule_code",
        "transaction_id",
        "sender_iban_truncated",
        customer if key is None else pseudonymize_iban(customer, key).alias("customer_id"),
        "risk_tier",
        ROLLING,
    ).orderBy(F.desc(ROLLING), "transaction_id")


def live_feed(
    transactions: DataFrame, rows: int = 50, decisions: DataFrame | None = None
) -> DataFrame:
    """The latest transactions: a top-k, which keeps ``rows`` rows per task.

    Block ``decisions`` are laid over the chosen rows, not over the whole table, and
    only those on the chosen rows are ranked.
    """
    newest_first = [F.desc("executed_at"), F.desc("transaction_id")]
    latest = transactions.orderBy(*newest_first).limit(rows)
    if decisions is None:
        return latest
    # Broadcast: ``rows`` ids, whatever the tables hold.
    ids = F.broadcast(latest.select("transaction_id"))
    wanted = decisions.join(ids, "transaction_id", "left_semi")
    return apply_block_decisions(latest, wanted).orderBy(*newest_first)


def blocked_count(transactions: DataFrame) -> DataFrame:
    return transactions.agg(F.count_if(_is_blocked("status")).alias("blocked_transactions"))


def velocity_alerts(transactions: DataFrame) -> DataFrame:
    """Transactions that the velocity rule blocked."""
    return transactions.filter(F.col("blocked_reason").startswith(VELOCITY_PREFIX)).select(
        "transaction_id", "sender_iban", "executed_at", "blocked_reason"
    )
