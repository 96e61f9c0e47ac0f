"""Data-quality checks. Each returns the rows that fail; NULL passes value checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.upserts import absent_rows
from ledgerwatch.workspace import stage


class QualityError(Exception):
    """Raised by :func:`run_checks` when a check fails."""


@dataclass(frozen=True)
class Check:
    """One declared check; ``column`` is empty for a check of the whole table."""

    kind: str
    column: str = ""
    values: tuple[Any, ...] = ()
    low: Any = None
    high: Any = None
    length: int | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})"

    def violation(self) -> Column:
        """Predicate that is true on a failing row, and never NULL."""
        col = F.col(self.column)
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "accepted":
            bad = ~col.isin(*self.values)
        elif self.kind == "length":
            bad = F.length(col) != self.length
        elif self.kind == "max_length":
            bad = F.length(col) > self.length
        elif self.kind == "between":
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | (col < F.lit(self.low))
            if self.high is not None:
                bad = bad | (col > F.lit(self.high))
        else:
            raise ValueError(f"{self.kind} is not a check of single rows")
        return F.coalesce(bad, F.lit(False))


def unique(column: str) -> Check:
    return Check("unique", column)


def not_null(column: str) -> Check:
    return Check("not_null", column)


def accepted(column: str, values: Sequence[Any]) -> Check:
    return Check("accepted", column, values=tuple(values))


def length_is(column: str, length: int) -> Check:
    return Check("length", column, length=length)


def max_length(column: str, length: int) -> Check:
    return Check("max_length", column, length=length)


def between(column: str, low: Any = None, high: Any = None) -> Check:
    return Check("between", column, low=low, high=high)


def row_count(low: int = 0, high: int | None = None) -> Check:
    return Check("row_count", low=low, high=high)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(not_null(column).violation())


def check_accepted(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(accepted(column, values).violation())


def check_length(df: DataFrame, column: str, length: int) -> DataFrame:
    return df.filter(length_is(column, length).violation())


def check_between(df: DataFrame, column: str, low: Any = None, high: Any = None) -> DataFrame:
    return df.filter(between(column, low, high).violation())


def check_row_count(df: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    """One row with the count if it is out of bounds, else none."""
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    n_rows = F.col("n_rows")
    return counted.filter((n_rows < low) | (n_rows > high if high is not None else F.lit(False)))


def check_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: ``check_name`` and ``failures``.

    All row checks and row counts share a single aggregate over the table. Each
    uniqueness check is one more aggregate, over its column alone. For uniqueness
    the failures are the repeated values.
    """
    single = [check for check in checks if check.kind != "unique"]
    measures = []
    for check in single:
        if check.kind == "row_count":
            rows = F.count(F.lit(1))
            bad = (rows < check.low) | (rows > check.high if check.high is not None else F.lit(False))
            measures.append(bad.cast("bigint"))
        else:
            measures.append(F.count_if(check.violation()))
    parts = []
    if single:
        wide = df.agg(*(m.alias(f"_{i}") for i, m in enumerate(measures)))
        lines = [
            F.struct(F.lit(check.name).alias("check_name"), F.col(f"_{i}").alias("failures"))
            for i, check in enumerate(single)
        ]
        parts.append(wide.select(F.inline(F.array(*lines))))
    for check in checks:
        if check.kind == "unique":
            repeated = check_unique(df, check.column).agg(F.count(F.lit(1)).alias("failures"))
            parts.append(repeated.select(F.lit(check.name).alias("check_name"), "failures"))
    return reduce(DataFrame.unionByName, parts)


def run_checks(df: DataFrame, checks: Sequence[Check], table: str = "table") -> DataFrame:
    """Gate: raise :class:`QualityError` if a check fails, else return the report.

    What reaches the driver is one line per check.
    """
    report = check_report(df, checks)
    lines = report.collect()
    failed = [f"{row.check_name}: {row.failures}" for row in lines if row.failures]
    if failed:
        raise QualityError(f"{table} failed {len(failed)} checks: " + "; ".join(sorted(failed)))
    return df.sparkSession.createDataFrame(lines, report.schema)


def split_at_load(
    df: DataFrame, checks: Sequence[Check], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The rows that a table with these constraints takes, and the others with the reason.

    Rows are inserted one by one in ``order``; equal ones come in any fixed order. A row that
    fails a row check is not inserted and holds no key. Of the others, one is refused if a row
    inserted before has the same value in a column with a ``unique`` check; NULL repeats nothing.
    """
    keys = [check.column for check in checks if check.kind == "unique"]
    single = [check for check in checks if check.kind not in ("unique", "row_count")]
    names = F.array_compact(F.array(*(F.when(c.violation(), c.name) for c in single)))
    place = F.struct(*order, F.monotonically_increasing_id().alias("_row"))
    # Written once, so that a row keeps its number.
    marked = stage(df.withColumns({"reason": F.array_join(names, "; "), "_arrival": place}), "load")
    passed = marked.filter(F.col("reason") == "")
    bad = marked.filter(F.col("reason") != "").select(*df.columns, "reason")
    if not keys:
        return passed.select(*df.columns), bad
    added = absent_rows(passed.limit(0), passed, [[key] for key in keys], "_arrival")
    added = stage(added, "loaded")
    refused = passed.join(added.select("_arrival"), "_arrival", "left_anti")
    held = []
    for key in keys:
        holder = added.filter(F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.lit(unique(key).name).alias(f"_why{len(held)}"))
        refused = refused.join(holder, F.col(key) == F.col("_key"), "left").drop("_key")
        held.append(f"_why{len(held)}")
    refused = refused.withColumn("reason", F.concat_ws("; ", *held)).select(*df.columns, "reason")
    return added.select(*df.columns), bad.unionByName(refused)


def split_by_checks(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all row checks, and the others with the names of what they fail."""
    names = F.array_compact(F.array(*(F.when(c.violation(), c.name) for c in checks)))
    marked = df.withColumn("reason", F.array_join(names, "; "))
    good = marked.filter(F.col("reason") == "").drop("reason")
    return good, marked.filter(F.col("reason") != "")
