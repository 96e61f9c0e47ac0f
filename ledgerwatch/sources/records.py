"""Decoding, defaults and validation of source records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import iso_text
from ledgerwatch.schemas import (
    DEFAULT_STATUS,
    HOME_COUNTRY,
    PAYMENT_CHANNELS,
    RISK_TIERS,
    STATUSES,
    TRANSACTION_COLUMNS,
    TRANSACTION_EVENT,
)

CUSTOMER_DEFAULTS = {"country": HOME_COUNTRY}
TRANSACTION_DEFAULTS = {"status": DEFAULT_STATUS}
CUSTOMER_DOMAINS = {"risk_tier": RISK_TIERS}
TRANSACTION_DOMAINS = {"payment_channel": PAYMENT_CHANNELS, "status": STATUSES}


def decode_events(events: DataFrame, value: str = "value", payload: str | None = None) -> DataFrame:
    """Transaction columns from JSON text; other columns are kept.

    Broken JSON gives NULL columns, which validation then reports. The event time
    stays text. ``payload`` names a column for the text as it came, so that a
    quarantined record can be read and sent again. ``inline`` keeps the optimizer from copying the parser into every
    expression above, where it would run once per column.
    """
    kept = [F.col(name) for name in events.columns if name != value]
    if payload is not None:
        kept.append(F.col(value).cast("string").alias(payload))
    parsed = F.from_json(F.col(value).cast("string"), TRANSACTION_EVENT)
    return events.select(*kept, F.inline(F.array(parsed)))


def encode_events(transactions: DataFrame) -> DataFrame:
    """``key`` and JSON ``value`` for publishing.

    The key is the sender, so that one sender's events stay in order in the feed.
    """
    fields = [
        iso_text(F.col(name)).alias(name) if name == "executed_at" else F.col(name)
        for name in TRANSACTION_COLUMNS
    ]
    body = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return transactions.select(F.col("sender_iban").alias("key"), body.alias("value"))


def with_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    """Fill columns that are absent or NULL."""
    filled: dict[str, Column] = {}
    for name, value in defaults.items():
        given = F.col(name) if name in df.columns else F.lit(None).cast("string")
        filled[name] = F.coalesce(given, F.lit(value))
    return df.withColumns(filled)


def flag_records(
    df: DataFrame,
    required: Sequence[str],
    domains: Mapping[str, Sequence[str]],
    times: Sequence[str] = (),
) -> DataFrame:
    """Add ``reason``: the faults of a record in a fixed order, or an empty text.

    Columns in ``times`` are read as ISO-8601 text and come out as timestamps.
    """
    faults = [F.when(F.col(name).isNull(), f"missing {name}") for name in required]
    for name, values in domains.items():
        faults.append(F.when(~F.col(name).isin(*values), f"unknown {name}"))
    read = {name: F.col(name).try_cast("timestamp_ntz") for name in times}
    for name, value in read.items():
        faults.append(F.when(F.col(name).isNotNull() & value.isNull(), f"bad {name}"))
    reason = F.array_join(F.array_compact(F.array(*faults)), "; ")
    return df.withColumns({**read, "reason": reason})


def validate_records(
    df: DataFrame,
    required: Sequence[str],
    domains: Mapping[str, Sequence[str]],
    times: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Split into valid records, and a quarantine with the reason.

    No record is dropped. A time that cannot be read is NULL in the quarantine, and
    broken JSON is all NULL: decode with a ``payload`` column to keep their text.
    """
    flagged = flag_records(df, required, domains, times)
    valid = flagged.filter(F.col("reason") == "").drop("reason")
    return valid, flagged.filter(F.col("reason") != "")
