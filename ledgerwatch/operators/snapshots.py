"""Type-2 history of a dimension, and point-in-time reads of it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import timestamp_ntz
from ledgerwatch.operators.staging import masked_iban

CUSTOMER_KEY = "customer_id"
CUSTOMER_CHECKS = ("risk_tier", "address", "city")
VALIDITY = ("version_id", "updated_at", "valid_from", "valid_to")


def snapshot_source(raw_customers: DataFrame, key: str) -> DataFrame:
    """The customer columns that are kept in history."""
    return raw_customers.select(
        "customer_id",
        *masked_iban("iban", key),
        "address",
        "city",
        "country",
        "risk_tier",
        "created_at",
    )


def _version_id(key: Column, since: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), since.cast("string")))


def _differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """Null-safe: a change from or to NULL is a change."""
    old = F.struct(*(F.col(f"{left}.{c}").alias(c) for c in columns))
    new = F.struct(*(F.col(f"{right}.{c}").alias(c) for c in columns))
    return ~old.eqNullSafe(new)


def empty_history(source: DataFrame) -> DataFrame:
    """A history without versions, for the first run."""
    none = F.lit(None)
    return source.limit(0).withColumns(
        {
            "version_id": none.cast("string"),
            "updated_at": none.cast("timestamp_ntz"),
            "valid_from": none.cast("timestamp_ntz"),
            "valid_to": none.cast("timestamp_ntz"),
        }
    )


def scd2_apply(
    current: DataFrame, source: DataFrame, key: str, check_cols: Sequence[str], run_ts: datetime
) -> DataFrame:
    """History after one more run.

    A new key opens a version; a change in any of ``check_cols`` closes the open
    version and opens another. Other changes leave the stored row as it is, and
    keys that are missing from the source stay open. ``current`` may hold open
    versions only: closed ones pass through unchanged.
    """
    columns = source.columns
    now = timestamp_ntz(run_ts)
    closed = current.filter(F.col("valid_to").isNotNull())
    live = current.filter(F.col("valid_to").isNull())

    same_key = F.col(f"old.{key}") == F.col(f"new.{key}")
    pair = live.alias("old").join(source.alias("new"), same_key, "full_outer")
    known = F.col(f"old.{key}").isNotNull()
    given = F.col(f"new.{key}").isNotNull()
    changed = known & given & _differs("old", "new", check_cols)
    kept = F.struct(
        *(F.col(f"old.{c}").alias(c) for c in columns),
        F.col("old.version_id").alias("version_id"),
        F.col("old.updated_at").alias("updated_at"),
        F.col("old.valid_from").alias("valid_from"),
        F.when(changed, now).alias("valid_to"),
    )
    opened = F.struct(
        *(F.col(f"new.{c}").alias(c) for c in columns),
        _version_id(F.col(f"new.{key}"), now).alias("version_id"),
        now.alias("updated_at"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    rows = F.array_compact(F.array(F.when(known, kept), F.when(~known | changed, opened)))
    after = pair.select(F.explode(rows).alias("_row")).select("_row.*")
    return closed.select(*after.columns).unionByName(after)


def scd2_history(
    batches: DataFrame, key: str, check_cols: Sequence[str], run_col: str
) -> DataFrame:
    """The history that running :func:`scd2_apply` on every batch would give.

    ``batches`` holds all source snapshots, told apart by their run time, with a
    key at most once per run. A window group is thus no longer than the number of
    runs.
    """
    columns = [name for name in batches.columns if name != run_col]
    runs = W.partitionBy(key).orderBy(run_col)
    state = F.struct(*check_cols)
    before = F.lag(state).over(runs)
    first = F.row_number().over(runs) == 1
    versions = batches.withColumn("_opens", first | ~before.eqNullSafe(state)).filter("_opens")
    ends = F.lead(run_col).over(runs)
    since = F.col(run_col)
    return versions.select(
        *columns,
        _version_id(F.col(key), since).alias("version_id"),
        since.alias("updated_at"),
        since.alias("valid_from"),
        ends.alias("valid_to"),
    )


def as_of(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    at: Column,
    prefix: str = "asof_",
    how: str = "left",
) -> DataFrame:
    """Join each fact to the version that was valid at its time.

    Intervals are half-open. The versions of a key do not overlap, so a fact meets
    at most one of them. The columns of the version get ``prefix``. ``history`` should
    be a stored table: Spark splits a hot key only if both sides are shuffled for the
    join, and a history fresh from its window is not shuffled again.
    """
    versions = history.select(
        *(F.col(name).alias(f"{prefix}{name}") for name in history.columns)
    )
    start, end = F.col(f"{prefix}valid_from"), F.col(f"{prefix}valid_to")
    match = (
        (F.col(key) == F.col(f"{prefix}{key}"))
        & (start <= F.col("_at"))
        & (end.isNull() | (F.col("_at") < end))
    )
    joined = facts.withColumn("_at", at).join(versions, match, how)
    return joined.drop("_at", f"{prefix}{key}")
