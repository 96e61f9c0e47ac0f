"""Batch form of the velocity rule: too many instant transfers within the window."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import velocity_reason
from ledgerwatch.operators.sliding import HOT_ROWS, RANGE_ROWS, sliding_totals
from ledgerwatch.schemas import VelocityRule
from ledgerwatch.workspace import stage_counted


def risk_lookup(customers: DataFrame) -> DataFrame:
    """Sender IBAN and risk tier of every customer."""
    return customers.select("iban", "risk_tier")


def watched_senders(customers: DataFrame, rule: VelocityRule = VelocityRule()) -> DataFrame:
    """The part of the lookup whose tiers the rule watches."""
    lookup = risk_lookup(customers).filter(F.col("risk_tier").isin(*rule.risk_tiers))
    return lookup.withColumnRenamed("iban", "sender_iban")


def velocity_candidates(
    payments: DataFrame,
    customers: DataFrame,
    rule: VelocityRule = VelocityRule(),
    arrival: str = "transaction_id",
) -> DataFrame:
    """Payments the rule counts: watched channel, known sender in a watched tier."""
    watched = payments.filter(F.col("payment_channel").isin(*rule.channels))
    rows = watched.join(watched_senders(customers, rule), "sender_iban")
    return rows.filter(F.col("executed_at").isNotNull()).select(
        "transaction_id", "sender_iban", "executed_at", F.col(arrival).alias("arrival"), "risk_tier"
    )


def velocity_counts(
    candidates: DataFrame,
    rule: VelocityRule = VelocityRule(),
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``event_count``: candidates of the sender in the window, this one included.

    The window is open on the left. Of payments with one time stamp, each sees
    those that arrived before it. ``candidates`` is read several times.
    """
    return sliding_totals(
        candidates,
        key="sender_iban",
        at="executed_at",
        measures={"event_count": F.lit(1).cast("bigint")},
        leaves_after=timedelta(minutes=rule.window_minutes),
        tie_break="arrival",
        hot_rows=hot_rows,
        rows=rows,
        range_rows=range_rows,
    )


def blocks_from_counts(counts: DataFrame, rule: VelocityRule = VelocityRule(), *also: Column) -> DataFrame:
    """The counted payments that reach the limit, with the text of the block, and columns ``also``."""
    hits = counts.filter(F.col("event_count") >= rule.max_transactions)
    reason = velocity_reason(F.col("event_count"), rule.window_minutes, F.col("risk_tier"))
    return hits.select("transaction_id", "event_count", reason.alias("blocked_reason"), *also)


def velocity_batch(
    payments: DataFrame,
    customers: DataFrame,
    rule: VelocityRule = VelocityRule(),
    arrival: str = "transaction_id",
    hot_rows: int = HOT_ROWS,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Payments to block, for data whose arrival order follows the event time.

    Payments that were blocked keep counting, so the rest of a burst is blocked too.
    """
    candidates = velocity_candidates(payments, customers, rule, arrival)
    table, rows = stage_counted(candidates, "velocity")
    return blocks_from_counts(velocity_counts(table, rule, hot_rows, rows, range_rows), rule)
