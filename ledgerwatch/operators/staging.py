"""Silver staging: typed, pseudonymized projections of the bronze tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import (
    is_cross_border,
    parse_eu_amount,
    pseudonymize_iban,
    truncate_iban,
)

PII_COLUMNS = ("first_name", "last_name", "email", "phone_number", "address")


def masked_iban(column: str, key: str, prefix: str | None = None) -> list[Column]:
    """The two silver columns that stand for one raw IBAN column."""
    prefix = prefix or column
    return [
        pseudonymize_iban(F.col(column), key).alias(f"{prefix}_hmac"),
        truncate_iban(F.col(column)).alias(f"{prefix}_truncated"),
    ]


def stage_payments(
    raw: DataFrame, key: str, ingest_col: str = "ingested_at", strict: bool = True
) -> DataFrame:
    """Staged form of bronze transactions, or of settlements with ``ingest_col="loaded_at"``."""
    return raw.select(
        "transaction_id",
        *masked_iban("sender_iban", key),
        *masked_iban("beneficiary_iban", key),
        parse_eu_amount(F.col("amount"), strict).alias("amount_eur"),
        "currency",
        "payment_channel",
        "status",
        "blocked_reason",
        "executed_at",
        is_cross_border(F.col("beneficiary_iban")).alias("is_cross_border"),
        F.col(ingest_col).alias("ingested_at"),
    )


def stage_customers(raw: DataFrame, key: str, drop_pii: bool = False) -> DataFrame:
    """Staged customers. Only the IBAN is masked unless ``drop_pii`` is set."""
    staged = raw.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone_number",
        *masked_iban("iban", key),
        "address",
        "city",
        "country",
        "risk_tier",
        "created_at",
        "ingested_at",
    )
    return staged.drop(*PII_COLUMNS) if drop_pii else staged
