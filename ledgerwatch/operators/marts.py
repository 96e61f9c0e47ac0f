"""Gold marts: enriched transaction facts and rolling cross-border alerts."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import packed_hashes, timestamp_ntz, unpacked_hashes
from ledgerwatch.operators.sliding import HOT_ROWS, sliding_totals
from ledgerwatch.schemas import ROLLING_AMOUNT, CrossBorderRule
from ledgerwatch.workspace import stage_counted

FACT_COLUMNS = (
    "transaction_id",
    "sender_iban_hmac",
    "sender_iban_truncated",
    "beneficiary_iban_hmac",
    "beneficiary_iban_truncated",
    "amount_eur",
    "currency",
    "payment_channel",
    "final_status",
    "blocked_reason",
    "executed_at",
    "is_cross_border",
    "seen_in_stream",
    "seen_in_settlement",
    "customer_id",
    "risk_tier",
)
ALERT_GRAIN = (
    "sender_iban_hmac",
    "sender_iban_truncated",
    "transaction_id",
    "amount_eur",
    "executed_at",
)
ROLLING = "rolling_30d_cross_border_eur"


def with_customer(payments: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Add ``customer_id`` and ``risk_tier`` of the sender; unknown senders keep NULL.

    No broadcast hint: customers grow with the bank. The optimizer broadcasts a
    small side by itself, and splits a hot sender in a sort-merge join.
    """
    owner = stg_customers.select(
        F.col("iban_hmac").alias("sender_iban_hmac"), "customer_id", "risk_tier"
    )
    return unpacked_hashes(packed_hashes(payments).join(packed_hashes(owner), "sender_iban_hmac", "left"))


def fct_transactions(reconciled: DataFrame, stg_customers: DataFrame) -> DataFrame:
    """Every reconciled transaction with the customer who sent it."""
    return with_customer(reconciled, stg_customers).select(*FACT_COLUMNS)


def alert_candidates(reconciled: DataFrame, columns: tuple[str, ...] = ALERT_GRAIN) -> DataFrame:
    """Cross-border payments that were not blocked, with a known sender and time."""
    return reconciled.filter(
        F.col("is_cross_border")
        & (F.col("final_status") != "BLOCKED")
        & F.col("sender_iban_hmac").isNotNull()
        & F.col("executed_at").isNotNull()
    ).select(*columns)


def rolling_cross_border(
    reconciled: DataFrame,
    rule: CrossBorderRule = CrossBorderRule(),
    hot_rows: int = HOT_ROWS,
    merge_copies: bool = False,
) -> DataFrame:
    """Cross-border sum of the sender over the closed window of ``rule.days`` days.

    ``merge_copies`` is for input whose rows are not unique: equal rows become one
    row, and the sum counts once per copy, as a grouped self-join would give it.
    """
    rows = alert_candidates(reconciled)
    amount = F.col("amount_eur")
    if merge_copies:
        rows = rows.groupBy(*ALERT_GRAIN).agg(F.count(F.lit(1)).alias("_copies"))
        amount = amount * F.col("_copies")
    table, n_rows = stage_counted(rows, "cross-border")
    totals = sliding_totals(
        table,
        key="sender_iban_hmac",
        at="executed_at",
        measures={
            "_total": F.coalesce(amount, F.lit(0)).cast(ROLLING_AMOUNT),
            "_known": amount.isNotNull().cast("bigint"),
        },
        # A row that is exactly ``days`` old still counts.
        leaves_after=timedelta(days=rule.days, microseconds=1),
        hot_rows=hot_rows,
        rows=n_rows,
    )
    total = F.when(F.col("_known") > 0, F.col("_total"))
    if merge_copies:
        total = total * F.col("_copies")
    return totals.select(*ALERT_GRAIN, total.cast(ROLLING_AMOUNT).alias(ROLLING))


def aml_alerts(
    reconciled: DataFrame,
    stg_customers: DataFrame,
    run_ts: datetime,
    rule: CrossBorderRule = CrossBorderRule(),
    hot_rows: int = HOT_ROWS,
    merge_copies: bool = False,
) -> DataFrame:
    """Payments whose rolling cross-border sum is above the threshold.

    ``detected_at`` is the run time, so a rerun gives the same rows.
    """
    rolling = rolling_cross_border(reconciled, rule, hot_rows, merge_copies)
    above = rolling.filter(F.col(ROLLING) > F.lit(rule.threshold))
    return with_customer(above, stg_customers).select(
        "transaction_id",
        "sender_iban_hmac",
        "sender_iban_truncated",
        "customer_id",
        "risk_tier",
        "amount_eur",
        "executed_at",
        ROLLING,
        F.lit(rule.code).alias("rule_code"),
        timestamp_ntz(run_ts).alias("detected_at"),
    )
