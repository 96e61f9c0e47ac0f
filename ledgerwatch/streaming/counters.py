"""Running counts of a streaming job, taken from its progress reports."""

from __future__ import annotations

from collections import Counter, defaultdict
from threading import Event

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def counted(df: DataFrame, name: str) -> DataFrame:
    """Report the number of rows that pass here, once per micro-batch, as ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def counted_where(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """The same for the rows that meet a condition, one counter for each name."""
    for name, condition in conditions.items():
        df = df.observe(name, F.count_if(condition).alias("rows"))
    return df


class RunCounters(StreamingQueryListener):
    """Adds up the counts of :func:`counted` over a run: ``counters["blocked"]``.

    Register it with ``spark.streams.addListener``. Each report is one number, so
    nothing but counts reaches the driver. ``by_run`` has them by the run of a query,
    which is new after each restart from a checkpoint.
    """

    def __init__(self) -> None:
        self.totals: Counter[str] = Counter()
        self.by_run: dict[str, Counter[str]] = defaultdict(Counter)
        self.ended: dict[str, Event] = defaultdict(Event)

    def __getitem__(self, name: str) -> int:
        return self.totals[name]

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.totals[name] += row["rows"]
            self.by_run[str(event.progress.runId)][name] += row["rows"]

    def of_run(self, query: StreamingQuery, seconds: float = 60) -> Counter[str]:
        """The counts of a run that has ended, once its last report has come in."""
        if not self.ended[str(query.runId)].wait(seconds):
            raise TimeoutError(f"the run {query.runId} has not reported its end")
        return self.by_run[str(query.runId)]

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()
