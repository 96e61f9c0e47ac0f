"""Running totals over a trailing time window, per key, whatever the key skew.

The total at time T is what has entered up to T less what has left by then. Both
parts are running sums from the start of the key, which Spark updates row by row;
a bounded RANGE frame would be summed anew for every row.

Keys with many rows do not fit one window task. Their rows are cut into ranges of about equal
size, in the order of key, time and tie break, so that neither a key nor a single time stamp makes a
range large. Each range is summed, the sums of a key's earlier ranges are carried
forward, and each (key, range) group then only needs its own rows and one carry row. Both
ways are exact, therefore it does not matter for the result which way a key takes.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.workspace import stage

HOT_ROWS = 1_000_000
#: Moves of one range, about; a range is one group of a window.
RANGE_ROWS = 500_000


def hot_keys(
    df: DataFrame, key: str, min_rows: int = HOT_ROWS, limit: int | None = None
) -> DataFrame:
    """The keys that have ``min_rows`` rows or more; only the ``limit`` largest, if that is given."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    largest = counts.filter(F.col("_rows") >= min_rows)
    if limit is not None:
        largest = largest.orderBy(F.desc("_rows"), key).limit(limit)
    return largest.select(key)


def _interval_sql(span: timedelta) -> str:
    hours, rest = divmod(span.seconds, 3600)
    minutes, seconds = divmod(rest, 60)
    clock = f"{hours:02}:{minutes:02}:{seconds:02}.{span.microseconds:06}"
    return f"INTERVAL '{span.days} {clock}' DAY TO SECOND"


def sliding_totals(
    df: DataFrame,
    key: str,
    at: str,
    measures: dict[str, Column],
    leaves_after: timedelta,
    tie_break: str | None = None,
    hot_rows: int = HOT_ROWS,
    rows: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add one column per measure: its total over the trailing window at each row.

    A row counts from its own time until ``leaves_after`` later, when it no longer
    counts. Rows with equal times see each other, or only their predecessors by
    ``tie_break`` if that is given. ``key`` and ``at`` must not be NULL, measures
    must not be NULL either. ``df`` is read several times and should be a table. If
    its number of ``rows`` is known to be below ``hot_rows``, no key can be hot and
    the plain window does it all. Else the moves of the hot keys are written by ranges
    while the result is planned. ``tie_break`` should tell a key's rows apart: rows that agree in it are not cut.
    """
    columns = [*df.columns, *measures]
    if rows is not None and rows < hot_rows:
        return _by_key(df, key, at, measures, leaves_after, tie_break).select(*columns)
    # All of them, so no hint: Spark broadcasts the list if it is small, and else splits the hot side.
    hot = hot_keys(df, key, hot_rows)
    few = df.join(hot, key, "left_anti")
    many = df.join(hot, key, "left_semi")
    plain = _by_key(few, key, at, measures, leaves_after, tie_break)
    if tie_break is None:
        ranged = _by_distinct_time(many, key, at, measures, leaves_after, range_rows)
    else:
        ranged = _by_range(many, key, at, measures, leaves_after, tie_break, range_rows)
    return plain.select(*columns).unionByName(ranged.select(*columns))


def _by_key(df, key, at, measures, leaves_after, tie_break) -> DataFrame:
    for name, value in measures.items():
        df = df.withColumn(f"_{name}", value)
    # The finer order comes first, then the second window reuses its sort.
    order = [at, tie_break] if tie_break else [at]
    entered = W.partitionBy(key).orderBy(*order)
    df = df.select("*", *(F.sum(f"_{n}").over(entered).alias(f"_in_{n}") for n in measures))
    gone = (
        f"OVER (PARTITION BY `{key}` ORDER BY `{at}` RANGE BETWEEN "
        f"UNBOUNDED PRECEDING AND {_interval_sql(leaves_after)} PRECEDING)"
    )
    df = df.select("*", *(F.expr(f"sum(`_{n}`) {gone}").alias(f"_out_{n}") for n in measures))
    for name in measures:
        left = F.coalesce(F.col(f"_out_{name}"), F.lit(0))
        df = df.withColumn(name, F.col(f"_in_{name}") - left)
    return df


def _by_distinct_time(df, key, at, measures, leaves_after, range_rows) -> DataFrame:
    """Rows with equal times share a total, so one row per time is enough to slide over.

    Times may be coarse, dates even, and a single one may hold a large part of a hot
    key. Its rows are summed before the shuffle, and meet the total in a join, which
    adaptive execution splits.
    """
    sums = {name: F.sum(value).alias(f"_sum_{name}") for name, value in measures.items()}
    times = df.groupBy(key, at).agg(*sums.values())
    summed = {name: F.col(f"_sum_{name}") for name in measures}
    totals = _by_range(times, key, at, summed, leaves_after, None, range_rows)
    return df.join(totals.select(key, at, *measures), [key, at])


def _by_range(df, key, at, measures, leaves_after, tie_break, range_rows) -> DataFrame:
    names = list(measures)
    leave_time = F.col(at) + F.expr(_interval_sql(leaves_after))
    row, tie = F.struct(*df.columns), F.col(tie_break) if tie_break else F.lit(0)
    # Two moves per row: it enters at its own time, and leaves later.
    enter = F.struct(
        F.col(at).alias("_at"),
        F.lit(1).alias("_enters"),
        tie.alias("_tie"),
        *(measures[n].alias(f"_{n}") for n in names),
        row.alias("_row"),
    )
    leave = F.struct(
        leave_time.alias("_at"),
        F.lit(0).alias("_enters"),
        tie.alias("_tie"),
        *((-measures[n]).alias(f"_{n}") for n in names),
        F.when(F.lit(False), row).alias("_row"),
    )
    moves = df.select(key, F.inline(F.array(enter, leave)))
    # What leaves at T is gone before what enters at T is looked at.
    order = ["_at", "_enters", "_tie"]
    ranges = max(1, -(-2 * df.count() // range_rows))
    own = stage(moves.repartitionByRange(ranges, key, *order).withColumn("_range", F.spark_partition_id()), "moves")
    sums = own.groupBy(key, "_range").agg(*(F.sum(f"_{n}").alias(f"_{n}") for n in names))
    # A row for each range of a key, so this window is small.
    earlier = W.partitionBy(key).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    carried = sums.select(key, "_range", *(F.sum(f"_{n}").over(earlier).alias(f"_{n}") for n in names))
    # Sums widen decimals; the carry goes back to a type both sides share.
    wide = {n: sums.schema[f"_{n}"].dataType for n in names}
    nothing = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("_at", "_tie", "_row")]
    zero_or = [F.coalesce(F.col(f"_{n}").cast(wide[n]), F.lit(0).cast(wide[n])).alias(f"_{n}") for n in names]
    carry = carried.select(key, *nothing, F.lit(0).alias("_enters"), *zero_or, "_range")
    own = own.select(key, "_at", "_tie", "_row", "_enters", *(F.col(f"_{n}").cast(wide[n]) for n in names), "_range")
    upto = W.partitionBy(key, "_range").orderBy(*(F.asc_nulls_first(c) for c in order))
    totals = own.unionByName(carry).select("_enters", "_row", *(F.sum(f"_{n}").over(upto).alias(n) for n in names))
    return totals.filter(F.col("_enters") == 1).select("_row.*", *names)
