"""Bronze loads: whole operational tables, and settlement files."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.columns import timestamp_ntz
from ledgerwatch.operators.upserts import last_per_key
from ledgerwatch.schemas import TRANSACTION_COLUMNS, TRANSACTIONS
from ledgerwatch.sources.lake import Lake, path_exists, run_id


def read_operational_table(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    lower: datetime,
    upper: datetime,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Read a source table over JDBC in parallel ranges of a time column.

    The bounds only set the ranges: rows outside them, and NULLs, are read too.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=lower.isoformat(sep=" "),
        upperBound=upper.isoformat(sep=" "),
        numPartitions=partitions,
        properties={"preferTimestampNTZ": "true", "fetchsize": "10000", **(properties or {})},
    )


def extract_to_bronze(
    source: DataFrame,
    lake: Lake,
    table: str,
    run_ts: datetime,
    audit_column: str = "ingested_at",
) -> DataFrame | None:
    """Load a whole source as the new version of a bronze table.

    Every row of the load has one audit time. An empty source loads nothing and
    leaves the previous version in force; the result is what readers now see.
    """
    if source.isEmpty():
        return lake.read("bronze", table)
    return lake.write(
        source.withColumn(audit_column, timestamp_ntz(run_ts)), "bronze", table, run_ts
    )


def read_settlement_files(spark: SparkSession, folder: str) -> DataFrame:
    """All settlement rows with the ``file_date`` of the file they stand in.

    A folder may hold ``file_date=<date>`` partitions, flat drops that are named
    ``settlement_<date>.parquet``, or both.
    """
    dated = T.StructType([*TRANSACTIONS.fields, T.StructField("file_date", T.DateType())])
    parts = []
    if path_exists(spark, f"{folder}/file_date=*"):
        exported = spark.read.schema(dated).option("basePath", folder)
        parts.append(exported.parquet(f"{folder}/file_date=*"))
    if path_exists(spark, f"{folder}/settlement_*.parquet"):
        drops = spark.read.schema(TRANSACTIONS).parquet(f"{folder}/settlement_*.parquet")
        name = F.substring_index("_metadata.file_path", "settlement_", -1)
        parts.append(drops.withColumn("file_date", F.left(name, F.lit(10)).cast("date")))
    if not parts:
        return spark.createDataFrame([], dated)
    return reduce(DataFrame.unionByName, parts)


def load_settlements(
    spark: SparkSession, folder: str, run_ts: datetime, mode: str = "merge_latest"
) -> DataFrame:
    """Settlement rows for bronze, with the load time.

    ``merge_latest`` keeps each transaction once, from the newest file that has it, and
    every row that has no id.
    ``latest_file`` keeps the newest file with any rows and nothing else.
    """
    rows = read_settlement_files(spark, folder)
    if mode == "latest_file":
        # No data column is read for this, and one date reaches the driver.
        newest: date | None = rows.agg(F.max("file_date")).first()[0]
        chosen = rows.filter(F.col("file_date") == F.lit(newest))
    elif mode == "merge_latest":
        # Rows without id are not copies of each other.
        named = F.col("transaction_id").isNotNull()
        chosen = last_per_key(rows.filter(named), ["transaction_id"], ["file_date"])
        chosen = chosen.unionByName(rows.filter(~named))
    else:
        raise ValueError(f"unknown mode {mode}")
    return chosen.select(*TRANSACTION_COLUMNS).withColumn("loaded_at", timestamp_ntz(run_ts))


LOADED_FILES = "settlement_files"


def new_settlement_files(lake: Lake, folder: str, before: datetime | None = None) -> DataFrame:
    """Files (``path``, ``modified``, ``length``, ``file_date``) that no committed load (``before`` some run) has taken. Only names are read.

    A file that was written again counts as new. Names are as in :func:`read_settlement_files`.
    """
    spark, kind = lake.spark, "path string, modified timestamp, length bigint, file_date date"
    if not path_exists(spark, f"{folder}/*"):
        return spark.createDataFrame([], kind)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
    day = F.regexp_extract("path", r"(?:file_date=|settlement_)(\d{4}-\d{2}-\d{2})", 1)
    files = listed.select("path", F.col("modificationTime").alias("modified"), "length", F.when(day != "", day).cast("date").alias("file_date"))
    files = files.filter(F.col("file_date").isNotNull())
    done = [run for run in lake.runs("bronze", "raw_settlements") if before is None or run < run_id(before)]
    taken = lake.read_all("bronze", LOADED_FILES, upto=done[-1]) if done else None
    return files if taken is None else files.join(taken, ["path", "modified", "length"], "left_anti")


def add_settlement_files(lake: Lake, folder: str, run_ts: datetime) -> DataFrame:
    """Merge the files that have come since the last load into the newest bronze version.

    Of a transaction the row from the newest ``file_date`` wins, whichever load has brought it, so
    loads in any order give what one load of all files gives; ``loaded_at`` is the time of the load that
    brought the row. Rows without id are all kept. Files of earlier loads are not opened. The list of
    files is written first and counts from the moment that the version is committed, so
    a run that breaks off is repeated as a whole.
    """
    spark = lake.spark
    # A run that is repeated starts from the one before it.
    previous = lake.read("bronze", "raw_settlements", before=run_ts)
    if previous is not None and "file_date" not in previous.columns:
        raise ValueError("the newest version was loaded in another mode, without the dates of its files")
    files = lake.write(new_settlement_files(lake, folder, run_ts), "bronze", LOADED_FILES, run_ts)
    # Names of one load's files, not of all there are.
    paths = [row.path for row in files.select("path").toLocalIterator()]
    columns = [*TRANSACTION_COLUMNS, "loaded_at", "file_date"]
    rows = spark.createDataFrame([], TRANSACTIONS).withColumn("file_date", F.lit(None).cast("date"))
    if paths:
        day = F.regexp_extract(F.col("_metadata.file_path"), r"(?:file_date=|settlement_)(\d{4}-\d{2}-\d{2})", 1)
        rows = spark.read.schema(TRANSACTIONS).parquet(*paths).withColumn("file_date", day.cast("date"))
    rows = rows.withColumn("loaded_at", timestamp_ntz(run_ts)).select(*columns)
    if previous is not None:
        rows = rows.unionByName(previous.select(*columns))
    named = F.col("transaction_id").isNotNull()
    latest = last_per_key(rows.filter(named), ["transaction_id"], ["file_date", "loaded_at"])
    return lake.write(latest.unionByName(rows.filter(~named)), "bronze", "raw_settlements", run_ts)


def settlement_file_to_bronze(lake: Lake, path: str, run_ts: datetime) -> DataFrame | None:
    """Load a single settlement file as the new bronze version, unless it is empty."""
    rows = lake.spark.read.schema(TRANSACTIONS).parquet(path)
    return extract_to_bronze(rows, lake, "raw_settlements", run_ts, "loaded_at")


def settlements_to_bronze(
    lake: Lake, folder: str, run_ts: datetime, mode: str = "merge_latest"
) -> DataFrame:
    """Load the settlement files as the new bronze version.

    Without any settlement row the previous version stays in force, and the very
    first load writes an empty table. ``incremental`` opens only the files that are new.
    """
    if mode == "incremental":
        return add_settlement_files(lake, folder, run_ts)
    nothing_new = read_settlement_files(lake.spark, folder).isEmpty()
    previous = lake.read("bronze", "raw_settlements") if nothing_new else None
    if previous is not None:
        return previous
    rows = load_settlements(lake.spark, folder, run_ts, mode)
    return lake.write(rows, "bronze", "raw_settlements", run_ts)
