"""Shared scratch space for intermediate tables.

A table that several plans read is written once to the shared folder that the
cluster names in ``spark.checkpoint.dir``. The files outlive executors, cut the
lineage, and give later scans column pruning, which a row checkpoint would not.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Of written tables: hashes in hex digits take half of what the default codec needs.
CODEC = "zstd"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this application, without a trailing slash."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerwatch-"))
        folder = context.getCheckpointDir()
    return f"{folder.rstrip('/')}/ledgerwatch/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below :func:`scratch_root` that no other call gets."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on any file system Spark knows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _write(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once; return a DataFrame that reads it back, and its number of rows.

    The rows are counted while they are written. The files stay until the
    application's folder is removed, since the reader may be used at any time.
    """
    return _write(df, new_folder(df.sparkSession, label))


def stage(df: DataFrame, label: str) -> DataFrame:
    """:func:`stage_counted` without the number of rows."""
    return stage_counted(df, label)[0]


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[tuple[DataFrame, int]]:
    """:func:`stage_counted` for a block of code; the files are deleted after it."""
    path = new_folder(df.sparkSession, label)
    try:
        yield _write(df, path)
    finally:
        delete_folder(df.sparkSession, path)
