"""Silver reconciliation of live payments with settlements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import is_cross_border, parse_eu_amount
from ledgerwatch.operators.staging import masked_iban


def _full_outer(live: DataFrame, settled: DataFrame, live_first: list[str], amount: str):
    """Join on the id; the live value wins everywhere but for the amount.

    A live BLOCKED stays blocked, a settlement makes everything else SETTLED.
    """
    live, settled = live.alias("live"), settled.alias("settled")
    in_stream = F.col("live.transaction_id").isNotNull()
    in_settlement = F.col("settled.transaction_id").isNotNull()
    live_status = F.col("live.status")
    return live.join(
        settled, F.col("live.transaction_id") == F.col("settled.transaction_id"), "full_outer"
    ).select(
        *(F.coalesce(f"live.{name}", f"settled.{name}").alias(name) for name in live_first),
        F.coalesce(f"settled.{amount}", f"live.{amount}").alias(amount),
        F.when(live_status == "BLOCKED", live_status)
        .when(in_settlement, "SETTLED")
        .otherwise(live_status)
        .alias("final_status"),
        F.col("live.blocked_reason").alias("blocked_reason"),
        in_stream.alias("seen_in_stream"),
        in_settlement.alias("seen_in_settlement"),
    )


COLUMNS = (
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
)


def reconcile(stg_transactions: DataFrame, stg_settlements: DataFrame) -> DataFrame:
    """Reconcile two staged inputs; one row per transaction id if both ids are unique."""
    staged_live_first = [
        name
        for name in COLUMNS
        if name in stg_transactions.columns and name not in ("amount_eur", "blocked_reason")
    ]
    joined = _full_outer(stg_transactions, stg_settlements, staged_live_first, "amount_eur")
    return joined.select(*COLUMNS)


def reconcile_raw(
    transactions: DataFrame, settlements: DataFrame, key: str, strict: bool = True
) -> DataFrame:
    """Same result as :func:`reconcile` over the staged inputs, straight from bronze.

    Masking runs after the join. That shuffles the short raw texts in place of the
    64-character hashes, and hashes each reconciled row once instead of once per side.
    Amounts are parsed before it, each side for itself, as the staged inputs are.
    """
    raw_live_first = [
        "transaction_id",
        "sender_iban",
        "beneficiary_iban",
        "currency",
        "payment_channel",
        "executed_at",
    ]
    parsed = {"amount_eur": parse_eu_amount(F.col("amount"), strict)}
    joined = _full_outer(
        transactions.withColumns(parsed), settlements.withColumns(parsed), raw_live_first, "amount_eur"
    )
    return joined.select(
        "*",
        *masked_iban("sender_iban", key),
        *masked_iban("beneficiary_iban", key),
        is_cross_border(F.col("beneficiary_iban")).alias("is_cross_border"),
    ).select(*COLUMNS)
