"""Versioned Parquet tables in layers.

Each run writes its own version folder, ``layer/table/run=<id>``, and readers
take the newest one that has committed. A table is never overwritten in place, so
a failed run leaves the old version readable, and a retried run only replaces its
own folder.

Tables that every run adds to can be compacted: runs that nobody will write again become one
folder, ``layer/table/range=<tier>_<first>_<last>``. From the moment it is committed, readers
leave out what it covers, so the single folders may go at any time after that.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.workspace import CODEC, delete_folder

DEFAULT_LAYER = "default"


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, on any file system Spark knows."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(status.getPath()) for status in system.globStatus(path) or []]


def path_exists(spark: SparkSession, pattern: str) -> bool:
    return bool(matching_paths(spark, pattern))


def run_id(run: datetime | int) -> str:
    """Sortable name of a run, given by its time or by its micro-batch number."""
    return f"{run:012d}" if isinstance(run, int) else run.strftime("%Y%m%dT%H%M%S%f")


class Lake:
    """Tables below one root folder on the shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, layer: str | None, table: str) -> str:
        """The layer name is used as given; without one the table goes to a default layer."""
        return f"{self.root}/{layer or DEFAULT_LAYER}/{table}"

    def runs(self, layer: str | None, table: str) -> list[str]:
        """Committed runs of a table, oldest first."""
        marks = matching_paths(self.spark, f"{self.folder(layer, table)}/run=*/_SUCCESS")
        return sorted(mark.split("/")[-2].removeprefix("run=") for mark in marks)

    def pieces(self, layer: str | None, table: str) -> list[tuple[str, str, int, str]]:
        """First and last run, tier and path of the committed folders that hold the runs, in order, each run in one of them."""
        folder = self.folder(layer, table)
        found = [(run, run, 0, f"{folder}/run={run}") for run in self.runs(layer, table)]
        for mark in matching_paths(self.spark, f"{folder}/range=*/_SUCCESS"):
            name = mark.split("/")[-2]
            tier, first, last = name.removeprefix("range=").split("_")
            found.append((first, last, int(tier), f"{folder}/{name}"))
        held, end = [], ""
        for piece in sorted(found, key=lambda p: (p[0], -p[2])):
            if piece[0] > end:
                held.append(piece)
                end = piece[1]
        return held

    def compact(self, layer: str | None, table: str, fan: int = 16, open_runs: int = 2) -> None:
        """Rewrite ``fan`` neighbouring folders of a tier as one of the next, while there are as many.

        The newest ``open_runs`` runs stay single, since a restart may write them again. A table of
        ``n`` runs is left with about ``fan * log(n, fan)`` folders, and a row is rewritten once a tier.
        """
        merged = True
        while merged:
            merged = False
            held = self.pieces(layer, table)
            closed = held[: len(held) - open_runs]
            for tier in sorted({p[2] for p in closed}):
                same = [p for p in closed if p[2] == tier]
                if len(same) >= fan:
                    some = same[:fan]
                    name = f"range={tier + 1}_{some[0][0]}_{some[-1][1]}"
                    rows = self.spark.read.parquet(*(p[3] for p in some))
                    rows.write.mode("overwrite").option("compression", CODEC).parquet(f"{self.folder(layer, table)}/{name}")
                    merged = True
                    break
        self._delete_covered(layer, table)

    def _delete_covered(self, layer: str | None, table: str) -> None:
        folder = self.folder(layer, table)
        held = {p[3] for p in self.pieces(layer, table)}
        every = [f"{folder}/{m.split('/')[-2]}" for m in matching_paths(self.spark, f"{folder}/r*=*/_SUCCESS")]
        for path in every:
            if path not in held:
                delete_folder(self.spark, path)

    def write(self, df: DataFrame, layer: str | None, table: str, run: datetime | int) -> DataFrame:
        """Write this run's version and return it as read back."""
        path = f"{self.folder(layer, table)}/run={run_id(run)}"
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def read(
        self, layer: str | None, table: str, before: datetime | int | None = None
    ) -> DataFrame | None:
        """The newest version, or the newest of an earlier run; None if there is none."""
        runs = self.runs(layer, table)
        if before is not None:
            runs = [run for run in runs if run < run_id(before)]
        if not runs:
            return None
        return self.spark.read.parquet(f"{self.folder(layer, table)}/run={runs[-1]}")

    def read_all(
        self, layer: str | None, table: str, upto: str | None = None
    ) -> DataFrame | None:
        """All versions together, or those up to a named run, for tables to which every run only adds."""
        pieces = [p for p in self.pieces(layer, table) if upto is None or p[0] <= upto]
        if not pieces:
            return None
        if upto is not None and pieces[-1][1] > upto:
            raise ValueError(f"{table} has been compacted beyond {upto}")
        return self.spark.read.parquet(*(p[3] for p in pieces))

    def keep_newest(self, layer: str | None, table: str, versions: int) -> None:
        """Delete all but the newest committed versions of a table."""
        for run in self.runs(layer, table)[:-versions]:
            delete_folder(self.spark, f"{self.folder(layer, table)}/run={run}")
