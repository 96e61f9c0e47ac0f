"""The velocity rule on the event feed.

Two engines give the same blocks for a feed in event-time order:

``velocity_stream`` keeps the window of each sender in the state store and follows
arrival order exactly, also for events that come out of order. A sender's events of
one micro-batch are handled by one task, so the source must bound the micro-batch.

``start_velocity_job`` counts each micro-batch together with the tail of the earlier
ones, by the same sliding totals as the batch rule. It stays in the JVM, and a sender
with a large part of all events is spread over many tasks, which suits backfills.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerwatch.functions.columns import (
    MICROS_PER_SECOND,
    from_micros,
    micros,
    velocity_reason,
)
from ledgerwatch.operators.sliding import HOT_ROWS
from ledgerwatch.operators.velocity import (
    blocks_from_counts,
    velocity_candidates,
    velocity_counts,
    watched_senders,
)
from ledgerwatch.schemas import VelocityRule
from ledgerwatch.sources.lake import Lake, run_id
from ledgerwatch.streaming.sender_state import OUTPUT, SenderWindow
from ledgerwatch.workspace import stage, staged

BROADCAST_ROWS = 2_000_000
#: Senders that a micro-batch must have events of before their times count as the time it is.
SENDERS_TELL_TIME = 3
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: A micro-batch then writes its changes to the checkpoint, not the state's files.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB; the session's setting is put back after it."""
    settings = {PROVIDER: ROCKSDB, CHANGELOG: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start_lookup(
    customers: DataFrame, rule: VelocityRule = VelocityRule(), max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """The watched senders as they are now, fixed for the life of a job.

    Broadcast only if a count shows that they are few enough.
    """
    lookup = stage(watched_senders(customers, rule), "risk-lookup")
    return F.broadcast(lookup) if lookup.count() <= max_rows else lookup


def with_event_time(events: DataFrame, delay: str) -> DataFrame:
    """Add ``event_time`` with a watermark, which Spark only has for instants.

    The zone-less time is taken as UTC, whatever the zone of the session.
    """
    instant = F.timestamp_micros(micros(F.col("executed_at")))
    return events.withColumn("event_time", instant).withWatermark("event_time", delay)


def without_replays(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop redelivered transactions that come within ``delay`` of event time."""
    once = with_event_time(events, delay).dropDuplicatesWithinWatermark(["transaction_id"])
    return once.drop("event_time")


def judged_stream(
    events: DataFrame,
    customers: DataFrame,
    rule: VelocityRule = VelocityRule(),
    mode: str = "exact",
    arrival: str = "arrival",
    delay: str = "1 hour",
) -> DataFrame:
    """Streaming DataFrame of block decisions and late transfers (``late``), from keyed state.

    ``events`` has the transaction columns and an ``arrival`` order. ``exact`` keeps
    the state of every watched sender, and no transfer is late. ``bounded`` forgets idle
    senders; in return a transfer that is not after the watermark, ``delay`` behind the newest transfer
    of a watched channel in earlier micro-batches, is not counted but passed on as late. The query has to
    start within :func:`rocksdb_state`.
    """
    if mode not in ("exact", "bounded"):
        raise ValueError(f"unknown mode {mode}")
    if events.sparkSession.conf.get(PROVIDER, None) != ROCKSDB:
        raise RuntimeError("keyed state needs RocksDB: build and start the query within rocksdb_state")
    bounded = mode == "bounded"
    watched = events.filter(F.col("payment_channel").isin(*rule.channels) & F.col("executed_at").isNotNull())
    if bounded:
        watched = with_event_time(watched, delay)
    # Without the event time itself: Spark would drop late rows before the state sees them.
    rows = watched.join(start_lookup(customers, rule), "sender_iban").select(
        "transaction_id",
        "sender_iban",
        "risk_tier",
        micros(F.col("executed_at")).alias("at_micros"),
        F.col(arrival).alias("arrival"),
    )
    span = rule.window_minutes * 60 * MICROS_PER_SECOND
    hits = rows.groupBy("sender_iban").transformWithStateInPandas(
        statefulProcessor=SenderWindow(rule.max_transactions, span, bounded),
        outputStructType=OUTPUT,
        outputMode="Append",
        timeMode="EventTime" if bounded else "None",
    )
    reason = velocity_reason(F.col("event_count"), rule.window_minutes, F.col("risk_tier"))
    in_time = ~F.col("late")
    return hits.select(
        "transaction_id",
        F.when(in_time, F.col("event_count")).alias("event_count"),
        F.when(in_time, reason).alias("blocked_reason"),
        from_micros(F.col("at_micros")).alias("decided_at"),
        "late",
    )


def velocity_stream(
    events: DataFrame,
    customers: DataFrame,
    rule: VelocityRule = VelocityRule(),
    mode: str = "exact",
    arrival: str = "arrival",
    delay: str = "1 hour",
) -> DataFrame:
    """The block decisions alone of :func:`judged_stream`."""
    return judged_stream(events, customers, rule, mode, arrival, delay).filter(~F.col("late")).drop("late")


def refuse_known_future(lake: Lake, table: str, batch_id: int) -> None:
    """Raise if the table holds later micro-batches: another checkpoint has written it."""
    if any(last > run_id(batch_id) for _, last, _, _ in lake.pieces("silver", table)):
        raise RuntimeError(f"{table} has micro-batches after {batch_id}: a new checkpoint needs a new table")


def decision_sink(decisions: DataFrame, lake: Lake, table: str = "block_decisions") -> DataStreamWriter:
    """Writer that appends decisions to a lake table, once per micro-batch.

    A replayed micro-batch replaces its own folder, so no decision is doubled. The
    folders are numbered as the checkpoint numbers its micro-batches: a query that
    starts from a new checkpoint needs a new table, and is refused an old one. Late
    transfers of :func:`judged_stream` go to ``<table>_late``, so that they can be looked
    into or judged again by the batch rule.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        refuse_known_future(lake, table, batch_id)
        if "late" not in batch.columns:
            lake.write(batch, "silver", table, batch_id)
        else:
            # The state is gone through once, not once for each table.
            with staged(batch, "judged") as (rows, _):
                lake.write(rows.filter("late").select("transaction_id", "decided_at"), "silver", f"{table}_late", batch_id)
                lake.write(rows.filter("not late").drop("late"), "silver", table, batch_id)
            lake.compact("silver", f"{table}_late")
        lake.compact("silver", table)

    return decisions.writeStream.outputMode("append").foreachBatch(write)


def start_velocity_job(
    events: DataFrame,
    customers: DataFrame,
    lake: Lake,
    rule: VelocityRule = VelocityRule(),
    arrival: str = "arrival",
    lateness: timedelta = timedelta(hours=1),
    hot_rows: int = HOT_ROWS,
    table: str = "block_decisions",
) -> DataStreamWriter:
    """Writer that decides every micro-batch with distributed sliding counts.

    Decisions go to ``silver/<table>``. The candidates that later events can still
    see go to ``silver/<table>_tail``: for each sender those of the window before its newest
    event, and of ``lateness`` more, within which late events get their full count. Senders whose
    newest event is longer ago than that leave it, so the tail follows the active senders. As for
    :func:`decision_sink`, a new checkpoint needs a new ``table``.
    """
    lookup = start_lookup(customers, rule).withColumnRenamed("sender_iban", "iban")
    keep = timedelta(minutes=rule.window_minutes) + lateness

    def decide(batch: DataFrame, batch_id: int) -> None:
        refuse_known_future(lake, table, batch_id)
        fresh = velocity_candidates(batch, lookup, rule, arrival).withColumn("fresh", F.lit(True))
        tail = lake.read("silver", f"{table}_tail", before=batch_id)
        if tail is not None:
            fresh = fresh.unionByName(tail.withColumn("fresh", F.lit(False)))
        with staged(fresh, "velocity") as (rows, n_rows):
            counted = velocity_counts(rows, rule, hot_rows, n_rows).filter("fresh")
            decided = blocks_from_counts(counted, rule, F.col("executed_at").alias("decided_at"))
            lake.write(decided, "silver", table, batch_id)
            # By each sender's own newest event: a wrong clock can't shorten the others' windows.
            newest = rows.groupBy(F.col("sender_iban").alias("sender")).agg(F.max("executed_at").alias("newest"))
            # Senders that have been idle for longer leave altogether. The time that they are held
            # against is the middle one of the new events, if these are of several senders.
            now = rows.filter("fresh").agg(F.percentile_approx(micros(F.col("executed_at")), 0.5).alias("middle"), F.count_distinct("sender_iban").alias("senders")).first()
            if now["senders"] >= SENDERS_TELL_TIME:
                newest = newest.filter(F.col("newest") > from_micros(F.lit(now["middle"])) - F.lit(keep))
            seen = rows.join(newest, F.col("sender_iban") == F.col("sender"))
            seen = seen.filter(F.col("executed_at") > F.col("newest") - F.lit(keep))
            lake.write(seen.drop("fresh", "sender", "newest"), "silver", f"{table}_tail", batch_id)
        # A replay of this micro-batch needs the tail before it.
        lake.keep_newest("silver", f"{table}_tail", 3)
        lake.compact("silver", table)

    return events.writeStream.outputMode("append").foreachBatch(decide)
