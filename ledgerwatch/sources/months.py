"""Tables that are kept by month, so that a run rewrites only the months that change.

A run writes the months it has computed to ``layer/table/run=<id>/month=<month>``. One small state table
names, for each table, the run that holds each month, and the bronze versions that these were
made from. It is written last and commits all tables at once: a run without it is not read.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.columns import packed_hashes, unpacked_hashes
from ledgerwatch.sources.lake import Lake, matching_paths, run_id
from ledgerwatch.workspace import CODEC, delete_folder

#: ``state[table][month]`` is the run that holds the month.
State = dict[str, dict[str, str]]
LAYER = "gold"
NO_MONTH = "none"
_STATE_ROW = "table string, part string, run string"


def month_of(at: str | Column) -> Column:
    """``2024-01``, or ``none`` without a time."""
    return F.coalesce(F.date_format(at, "yyyy-MM"), F.lit(NO_MONTH))


def months_in(rows: DataFrame, at: str = "executed_at") -> set[str]:
    """The months that hold rows; one value per calendar month reaches the driver."""
    return {row[0] for row in rows.select(month_of(at)).distinct().toLocalIterator()}


def read_state(lake: Lake, name: str, before: datetime | None = None) -> State | None:
    """The newest committed state, or that of an earlier run; None if there is none. A row per table and month."""
    rows = lake.read(LAYER, name, before=before)
    if rows is None:
        return None
    state: State = {}
    for row in rows.toLocalIterator():
        state.setdefault(row["table"], {})[row["part"]] = row["run"]
    return state


def write_state(lake: Lake, name: str, state: State, run: datetime) -> None:
    rows = [(table, part, held) for table, parts in state.items() for part, held in parts.items()]
    lake.write(lake.spark.createDataFrame(rows, _STATE_ROW).coalesce(1), LAYER, name, run)


def write_months(lake: Lake, rows: DataFrame, table: str, run: datetime, at: str = "executed_at") -> dict[str, str]:
    """Write rows by month and return the run under each month that has any.

    The rebalancing gives a month as many files as its size asks for, and small months one.
    """
    folder = f"{lake.folder(LAYER, table)}/run={run_id(run)}"
    dated = unpacked_hashes(packed_hashes(rows).withColumn("month", month_of(at)).hint("rebalance", "month"))
    dated.write.mode("overwrite").option("compression", CODEC).partitionBy("month").parquet(folder)
    return {path.rsplit("=", 1)[1]: run_id(run) for path in matching_paths(lake.spark, f"{folder}/month=*")}


def read_months(lake: Lake, table: str, schema: T.StructType, held: dict[str, str], months: Iterable[str] | None = None) -> DataFrame:
    """The rows of all held months, or of those that are named."""
    chosen = held if months is None else {m: held[m] for m in months if m in held}
    paths = [f"{lake.folder(LAYER, table)}/run={run}/month={month}" for month, run in sorted(chosen.items())]
    return lake.spark.read.schema(schema).parquet(*paths) if paths else lake.spark.createDataFrame([], schema)


def prune_months(lake: Lake, name: str, versions: int) -> None:
    """Keep the newest ``versions`` states, and delete months that none of them names."""
    lake.keep_newest(LAYER, name, versions)
    used, tables = set(), set()
    for run in lake.runs(LAYER, name):
        rows = lake.spark.read.parquet(f"{lake.folder(LAYER, name)}/run={run}")
        for row in rows.toLocalIterator():
            tables.add(row["table"])
            used.add((row["table"], f"run={row['run']}", f"month={row['part']}"))
    for table in tables:
        for path in matching_paths(lake.spark, f"{lake.folder(LAYER, table)}/run=*/month=*"):
            run, month = path.split("/")[-2:]
            if (table, run, month) not in used:
                delete_folder(lake.spark, path)
