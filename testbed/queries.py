"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerwatch.functions import columns as fn
from ledgerwatch.operators import kpis, marts, quality, settlements, snapshots, upserts, velocity
from ledgerwatch.operators import reconcile as joins
from ledgerwatch.operators.staging import stage_customers, stage_payments
from ledgerwatch.plans import batch, declared, incremental
from ledgerwatch.schemas import (
    TRANSACTION_COLUMNS,
    TRANSACTION_REQUIRED,
    VelocityRule,
)
from ledgerwatch.sources import bronze, events, exports, records
from ledgerwatch.sources.lake import Lake
from ledgerwatch.streaming import velocity as live
from ledgerwatch.streaming.counters import RunCounters, counted, counted_where
from ledgerwatch.workspace import new_folder, stage
from testbed import bank

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def stg_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_payments(bank.audited(bank.raw_transactions(spark, sf_dir)), bank.KEY)


def stg_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bank.audited(bank.raw_settlements(spark, sf_dir), "loaded_at")
    return stage_payments(raw, bank.KEY, "loaded_at")


def stg_cust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_customers(bank.audited(bank.raw_customers(spark, sf_dir)), bank.KEY)


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.reconcile_raw(
        bank.raw_transactions(spark, sf_dir), bank.raw_settlements(spark, sf_dir), bank.KEY
    )


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fct_transactions(reconciled(spark, sf_dir), stg_cust(spark, sf_dir))


def new_lake(spark: SparkSession) -> Lake:
    return Lake(spark, new_folder(spark, "lake"))


# Sources and sinks


@query
def src_bronze_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load, and then a load of an empty source, which must leave the first in force."""
    lake = new_lake(spark)
    source = bank.raw_transactions(spark, sf_dir)
    bronze.extract_to_bronze(source, lake, "raw_transactions", bank.RUN_TS)
    later = bank.RUN_TS + timedelta(hours=1)
    loaded = bronze.extract_to_bronze(source.filter("false"), lake, "raw_transactions", later)
    return loaded.drop("ingested_at")


def exported_settlements(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "settlements")
    exports.export_settlements(bank.settlement_files(spark, sf_dir), folder)
    return folder


@query
def src_settlements_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exported_settlements(spark, sf_dir)
    return bronze.load_settlements(spark, folder, bank.RUN_TS, "latest_file")


@query
def src_settlement_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's file becomes the whole of bronze, and an empty one changes nothing."""
    folder = exported_settlements(spark, sf_dir)
    lake = new_lake(spark)
    bronze.settlement_file_to_bronze(lake, f"{folder}/file_date=2024-01-20", bank.RUN_TS)
    later = bank.RUN_TS + timedelta(hours=1)
    empty = new_folder(spark, "settlement-empty")
    bank.raw_settlements(spark, sf_dir).limit(0).write.parquet(empty)
    return bronze.settlement_file_to_bronze(lake, empty, later)


@query
def src_settlements_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = exported_settlements(spark, sf_dir)
    return bronze.load_settlements(spark, folder, bank.RUN_TS, "merge_latest")


@query
def risk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity.risk_lookup(bank.raw_customers(spark, sf_dir))


@query
def block_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions on some payments, two on a few, and some on ids that do not exist."""
    number = F.col("event_id")
    decided = bank.ev(spark, sf_dir).filter(number % 31 == 0)
    known = F.col("transaction_id")
    first = decided.select(
        known,
        F.lit("FIRST").alias("blocked_reason"),
        (F.col("executed_at") + fn.interval(mins=1)).alias("decided_at"),
    )
    second = decided.select(
        F.when(number % 62 == 0, known).otherwise(F.concat(F.lit("X"), known)).alias("transaction_id"),
        F.lit("SECOND").alias("blocked_reason"),
        (F.col("executed_at") + fn.interval(mins=2)).alias("decided_at"),
    )
    decisions = first.unionByName(second)
    return upserts.apply_block_decisions(bank.raw_transactions(spark, sf_dir), decisions)


@query
def insert_absent_txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment arrives twice, with another status the second time."""
    number = F.substring("transaction_id", 2, 10).cast("bigint")
    source = bank.raw_transactions(spark, sf_dir)
    target = source.filter(number % 3 == 0)
    swapped = (number % 5 == 0).cast("int")
    first = source.withColumn("arrival", number * 2 + swapped)
    replay = source.withColumns(
        {"arrival": number * 2 + 1 - swapped, "status": F.lit("SETTLED")}
    )
    return upserts.insert_absent(target, first.unionByName(replay), [["transaction_id"]], "arrival")


@query
def insert_absent_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that collide by id or IBAN, also through rows that are skipped themselves."""
    number = F.substring("customer_id", 2, 9).cast("bigint")
    text = F.substring("customer_id", 2, 9)
    source = bank.raw_customers(spark, sf_dir)
    target = source.filter(number % 4 == 0)
    base = source.withColumn("arrival", number * 4)
    new_id = F.concat(F.lit("N"), text)
    new_iban = F.concat(F.lit("ZZ"), text)
    same_iban = source.filter(number % 3 == 0).withColumns(
        {"arrival": number * 4 + 1, "customer_id": new_id}
    )
    through_skipped = source.filter(number % 6 == 0).withColumns(
        {"arrival": number * 4 + 2, "customer_id": new_id, "iban": new_iban}
    )
    late = source.filter(number % 12 == 0).withColumns(
        {"arrival": number * 4 + 3, "customer_id": F.concat(F.lit("M"), text), "iban": new_iban}
    )
    incoming = base.unionByName(same_iban).unionByName(through_skipped).unionByName(late)
    return upserts.insert_absent(target, incoming, [["customer_id"], ["iban"]], "arrival")


@query
def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.encode_events(bank.raw_transactions(spark, sf_dir))


@query
def validate_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and quarantined events together, told apart by the reason, with the text they were sent as."""
    decoded = records.decode_events(bank.event_json(spark, sf_dir), payload="payload")
    filled = records.with_defaults(decoded, records.TRANSACTION_DEFAULTS)
    valid, quarantine = records.validate_records(
        filled, TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
    )
    return valid.withColumn("reason", F.lit("")).unionByName(quarantine)


@query
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "customers-csv")
    exports.export_customers_csv(bank.raw_customers(spark, sf_dir), path)
    return exports.read_customers_csv(spark, path)


@query
def src_settlements_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, each after a third of the daily files has come, in no order of days."""
    lake, folder = new_lake(spark), new_folder(spark, "settlements")
    files = stage(bank.settlement_files(spark, sf_dir), "settlements")
    for load in range(3):
        exports.export_settlements(files.filter(F.dayofmonth("file_date") * 2 % 3 == load), f"{folder}/drop{load}")
        rows = bronze.add_settlement_files(lake, folder, bank.RUN_TS + timedelta(hours=load))
    return rows


@query
def settlement_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of all days, and then one day exported again with other amounts."""
    folder = exported_settlements(spark, sf_dir)
    again = bank.settlement_files(spark, sf_dir).filter(F.col("file_date") == "2024-01-20")
    exports.export_settlements(again.withColumn("amount", F.lit("0,00")), folder)
    return bronze.read_settlement_files(spark, folder)


# Column functions


@query
def pseudonymize_iban(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.ev(spark, sf_dir)
    gaps = F.when(F.col("event_id") % 13 != 0, F.col("sender_iban"))
    return rows.select(
        "transaction_id",
        fn.pseudonymize_iban(gaps, bank.KEY).alias("sender_hash"),
        fn.pseudonymize_iban(F.left("beneficiary_iban", F.lit(3)), bank.KEY).alias("short_hash"),
    )


@query
def truncate_iban(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.ev(spark, sf_dir)
    gaps = F.when(F.col("event_id") % 13 != 0, F.col("sender_iban"))
    return rows.select(
        "transaction_id",
        fn.truncate_iban(gaps).alias("sender_masked"),
        fn.truncate_iban(F.left("beneficiary_iban", F.lit(3))).alias("short_masked"),
    )


@query
def parse_eu_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good amounts, the dot trap, a third decimal, text that is no amount, and NULL."""
    kind = F.col("event_id") % 7
    text = bank.european_text(F.col("cents"))
    odd = (
        F.when(kind == 0, F.translate(F.translate(text, ".", ""), ",", "."))
        .when(kind == 1, F.concat(text, F.lit("5")))
        .when(kind == 2, "abc")
        .when(kind != 3, text)
    )
    return bank.ev(spark, sf_dir).select(
        "transaction_id",
        fn.parse_eu_amount(text).alias("amount_strict"),
        fn.parse_eu_amount(odd, strict=False).alias("amount_lenient"),
    )


@query
def format_eu_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("cents").cast("decimal(18,0)") / 100
    return bank.ev(spark, sf_dir).select(
        "transaction_id", fn.format_eu_amount(amount).alias("amount_text")
    )


@query
def cross_border_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id") % 11
    odd = F.when(kind == 0, F.lower("beneficiary_iban")).when(kind != 1, F.col("beneficiary_iban"))
    return bank.ev(spark, sf_dir).select(
        "transaction_id", fn.is_cross_border(odd).alias("is_cross_border")
    )


@query
def date_exprs(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("executed_at")
    return bank.ev(spark, sf_dir).select(
        "transaction_id",
        (at - fn.interval(days=30)).alias("alert_window_start"),
        (at - fn.interval(mins=60)).alias("velocity_cutoff"),
        at.cast("date").alias("executed_on"),
        fn.iso_text(at).alias("executed_iso"),
        fn.iso_text(at).cast("timestamp_ntz").alias("parsed_back"),
        fn.micros(at).alias("epoch_micros"),
        fn.from_micros(fn.micros(at)).alias("from_epoch_micros"),
    )


# Silver


@query
def stg_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_tx(spark, sf_dir)


@query
def stg_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_set(spark, sf_dir)


@query
def stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_cust(spark, sf_dir)


@query
def stg_customers_without_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = bank.audited(bank.raw_customers(spark, sf_dir))
    return stage_customers(raw, bank.KEY, drop_pii=True)


@query
def settlement_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.lit("2024-02-10").cast("date")
    return settlements.settlement_eligible(bank.raw_transactions(spark, sf_dir), day)


@query
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.reconcile(stg_tx(spark, sf_dir), stg_set(spark, sf_dir))


@query
def reconcile_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconciled(spark, sf_dir)


# Gold


@query
def fct_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts(spark, sf_dir)


@query
def rolling_30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.rolling_cross_border(reconciled(spark, sf_dir))


@query
def rolling_30d_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the busier half of the senders taken as hot."""
    return marts.rolling_cross_border(reconciled(spark, sf_dir), hot_rows=20)


@query
def aml_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.aml_alerts(reconciled(spark, sf_dir), stg_cust(spark, sf_dir), bank.RUN_TS)


@query
def alerts_selfjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts over rows that are not unique, where the grouped self-join counts copies."""
    settled = bank.raw_settlements(spark, sf_dir)
    number = F.substring("transaction_id", 2, 10).cast("bigint")
    twice = settled.unionByName(settled.filter(number % 15 == 1))
    rows = joins.reconcile_raw(bank.raw_transactions(spark, sf_dir), twice, bank.KEY)
    return marts.aml_alerts(rows, stg_cust(spark, sf_dir), bank.RUN_TS, merge_copies=True)


@query
def velocity_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity.velocity_batch(
        bank.velocity_payments(spark, sf_dir), bank.raw_customers(spark, sf_dir), arrival="arrival"
    )


@query
def velocity_batch_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the busier senders taken as hot."""
    return velocity.velocity_batch(
        bank.velocity_payments(spark, sf_dir),
        bank.raw_customers(spark, sf_dir),
        arrival="arrival",
        hot_rows=12,
    )


@query
def velocity_one_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments of the busiest sender in one second, and every sender cut into ranges of some rows."""
    customers, feed = bank.raw_customers(spark, sf_dir), bank.velocity_payments(spark, sf_dir)
    feed = bank.one_second(feed, "sender_iban", velocity.velocity_candidates(feed, customers, arrival="arrival"))
    return velocity.velocity_batch(feed, customers, arrival="arrival", hot_rows=1, range_rows=16)


@query
def rolling_30d_one_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling sums with all payments of the busiest sender in one second."""
    rows = reconciled(spark, sf_dir)
    rows = bank.one_second(rows, "sender_iban_hmac", marts.alert_candidates(rows))
    return marts.rolling_cross_border(rows, hot_rows=1)


@query
def velocity_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table drained as a stream into the decision table.

    The files of the table carry no arrival order, so they are taken together.
    """
    lake = new_lake(spark)
    files = events.file_events(
        spark, f"{sf_dir}/event[s].parquet", bank.EVENTS, files_per_trigger=None
    )
    feed = bank.velocity_feed(files)
    job = live.start_velocity_job(feed, bank.raw_customers(spark, sf_dir), lake)
    checkpoint = new_folder(spark, "velocity-checkpoint")
    job.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return lake.read_all("silver", "block_decisions").drop("decided_at")


class LandedFeed:
    """A feed whose slices are put into a folder one after the other, each as the same number of files."""

    FILES, FILE_ROWS = 3, 100_000

    def __init__(self, feed: DataFrame):
        self.spark = feed.sparkSession
        self.folder, self.checkpoint = new_folder(self.spark, "landed"), new_folder(self.spark, "checkpoint")
        self.schema = feed.drop("slice").schema
        # By slice, so that landing one reads no other.
        path = new_folder(self.spark, "feed")
        feed.write.partitionBy("slice").parquet(path)
        self.rows = self.spark.read.schema(feed.schema).parquet(path)
        sizes = [row["count"] for row in self.rows.groupBy("slice").count().toLocalIterator()]
        # Files grow in number with the feed, but each must get rows of the smallest slice.
        self.files = max(self.FILES, min(-(-sum(sizes) // (bank.SLICES * self.FILE_ROWS)), min(sizes, default=0) // 1000))

    def land(self, *slices: int) -> None:
        for number in slices:
            rows = self.rows.filter(F.col("slice") == number).drop("slice")
            rows.repartition(self.files).write.mode("append").parquet(self.folder)

    def stream(self) -> DataFrame:
        """One slice in each micro-batch."""
        return events.file_events(self.spark, self.folder, self.schema, files_per_trigger=self.files)

    def drain(self, writer) -> StreamingQuery:
        """Run until all that has landed is done, from where the last run stopped."""
        started = writer.option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        started.awaitTermination()
        return started


ALL_SLICES = range(bank.SLICES)


@query
def velocity_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed state over six micro-batches of events that come out of order."""
    feed, lake = LandedFeed(bank.unordered_feed(spark, sf_dir)), new_lake(spark)
    feed.land(*ALL_SLICES)
    with live.rocksdb_state(spark):
        decisions = live.velocity_stream(feed.stream(), bank.raw_customers(spark, sf_dir))
        feed.drain(live.decision_sink(decisions, lake))
    return lake.read_all("silver", "block_decisions").drop("decided_at")


@query
def velocity_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate with its count, or as late: the rows that come in are those that come out."""
    feed, lake = LandedFeed(bank.unordered_feed(spark, sf_dir)), new_lake(spark)
    feed.land(*ALL_SLICES)
    with live.rocksdb_state(spark):
        customers, every = bank.raw_customers(spark, sf_dir), VelocityRule(max_transactions=1)
        judged = live.judged_stream(feed.stream(), customers, every, mode="bounded", delay="10 minutes")
        feed.drain(live.decision_sink(judged, lake))
    late = lake.read_all("silver", "block_decisions_late").select("transaction_id", F.lit(None).cast("bigint").alias("event_count"), F.lit(True).alias("late"))
    return lake.read_all("silver", "block_decisions").select("transaction_id", "event_count", F.lit(False).alias("late")).unionByName(late)


@query
def velocity_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that breaks off after its third micro-batch was written, but before that was known, and a second run."""
    feed, lake = LandedFeed(bank.unordered_feed(spark, sf_dir)), new_lake(spark)
    customers = bank.raw_customers(spark, sf_dir)

    def breaks_off(batch: DataFrame, batch_id: int) -> None:
        lake.write(batch, "silver", "block_decisions", batch_id)
        if batch_id == 2:
            raise RuntimeError("broken off")

    feed.land(*ALL_SLICES[:4])
    with live.rocksdb_state(spark):
        try:
            feed.drain(live.velocity_stream(feed.stream(), customers).writeStream.foreachBatch(breaks_off))
        except StreamingQueryException:
            pass
        feed.land(*ALL_SLICES[4:])
        feed.drain(live.decision_sink(live.velocity_stream(feed.stream(), customers), lake))
    return lake.read_all("silver", "block_decisions").drop("decided_at")


@query
def decisions_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that came in twenty micro-batches, one of them twice, after their folders were compacted."""
    lake, blocks = new_lake(spark), stage(velocity_batch(spark, sf_dir), "blocks")
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(20))
    for run in [*range(11), *range(10, 20)]:
        lake.write(blocks.filter(part == run), "silver", "block_decisions", run)
        lake.compact("silver", "block_decisions", fan=3)
    return lake.read_all("silver", "block_decisions")


@query
def replays_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments that are delivered again, within the delay and long after it, count once."""
    feed, lake = LandedFeed(bank.redelivered_feed(spark, sf_dir)), new_lake(spark)
    feed.land(*ALL_SLICES)
    with live.rocksdb_state(spark):
        once = live.without_replays(feed.stream(), "45 minutes")
        feed.drain(live.decision_sink(once, lake, "once"))
    return lake.read_all("silver", "once").groupBy("transaction_id", "executed_at").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, late events and blocks of two runs of one query, as its micro-batches report them."""
    feed, lake = LandedFeed(bank.unordered_feed(spark, sf_dir)), new_lake(spark)
    customers, totals, counts = bank.raw_customers(spark, sf_dir), RunCounters(), []
    spark.streams.addListener(totals)
    try:
        for run, slices in enumerate((ALL_SLICES[:3], ALL_SLICES[3:]), 1):
            feed.land(*slices)
            with live.rocksdb_state(spark):
                judged = live.judged_stream(counted(feed.stream(), "events"), customers, mode="bounded", delay="10 minutes")
                judged = counted_where(judged, {"late": F.col("late"), "blocked": ~F.col("late")})
                found = totals.of_run(feed.drain(live.decision_sink(judged, lake)))
            counts += [(run, name, found[name]) for name in ("events", "late", "blocked")]
    finally:
        spark.streams.removeListener(totals)
    return spark.createDataFrame(counts, "run int, counter string, total bigint")


# Customer history


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.scd2_history(
        bank.customer_batches(spark, sf_dir),
        snapshots.CUSTOMER_KEY,
        snapshots.CUSTOMER_CHECKS,
        "run_ts",
    )


@query
def scd2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same history, built one run after the other."""
    batches = stage(bank.customer_batches(spark, sf_dir), "batches")
    start = bank.datetime(2024, 1, 5)
    history = snapshots.empty_history(batches.drop("run_ts"))
    for run in range(6):
        run_ts = start + timedelta(days=14 * run)
        source = batches.filter(F.col("run_ts") == fn.timestamp_ntz(run_ts)).drop("run_ts")
        after = snapshots.scd2_apply(
            history, source, snapshots.CUSTOMER_KEY, snapshots.CUSTOMER_CHECKS, run_ts
        )
        history = stage(after, "history")
    return history


@query
def as_of_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was known about the sender when the payment was made."""
    known = facts(spark, sf_dir).select("transaction_id", "customer_id", "executed_at")
    history = stage(scd2_history(spark, sf_dir), "history")
    dated = snapshots.as_of(known, history, "customer_id", F.col("executed_at"))
    return dated.select(
        "transaction_id",
        "customer_id",
        "executed_at",
        "asof_risk_tier",
        "asof_city",
        "asof_valid_from",
    )


# Data quality


@query
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_unique(bank.dirty_payments(spark, sf_dir), "transaction_id")


@query
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_not_null(bank.dirty_payments(spark, sf_dir), "transaction_id")


@query
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.dirty_payments(spark, sf_dir)
    return quality.check_accepted(rows, "status", ["PENDING", "SETTLED", "BLOCKED"])


@query
def dq_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_length(bank.dirty_payments(spark, sf_dir), "sender_iban_hmac", 64)


@query
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_between(bank.dirty_payments(spark, sf_dir), "amount_eur", low=0, high=9000)


@query
def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_row_count(bank.dirty_payments(spark, sf_dir), low=1, high=10)


@query
def dq_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_report(bank.dirty_customers(spark, sf_dir), declared.SOURCE_CUSTOMERS)


@query
def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_report(bank.dirty_payments(spark, sf_dir), declared.STG_TRANSACTIONS)


@query
def dq_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [check for check in declared.STG_TRANSACTIONS if check.kind != "unique"]
    _, bad = quality.split_by_checks(bank.dirty_payments(spark, sf_dir), checks)
    return bad.select("event_id", "reason")


@query
def dq_at_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded rows, with an empty reason, and refused ones, also for a key that a loaded row holds."""
    rows = bank.dirty_payments(spark, sf_dir)
    good, bad = quality.split_at_load(rows, declared.STG_TRANSACTIONS, ["event_id"])
    every = good.withColumn("reason", F.lit("")).unionByName(bad)
    return every.select("event_id", "transaction_id", "reason")


# Dashboard


@query
def kpi_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_totals(facts(spark, sf_dir))


@query
def kpi_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_customers_by_tier(stg_cust(spark, sf_dir))


@query
def kpi_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_reconciliation(facts(spark, sf_dir))


@query
def kpi_fraud_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.kpi_fraud_breakdown(facts(spark, sf_dir))


@query
def alert_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.alert_listing(aml_alerts(spark, sf_dir))


def operational(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Payments, and the decisions of the velocity rule on them."""
    decisions = velocity_batch(spark, sf_dir).withColumn(
        "decided_at", fn.timestamp_ntz(bank.RUN_TS)
    )
    return bank.velocity_payments(spark, sf_dir).select(*TRANSACTION_COLUMNS), decisions


def decided_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upserts.apply_block_decisions(*operational(spark, sf_dir))


@query
def live_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, decisions = operational(spark, sf_dir)
    return kpis.live_feed(payments, rows=50, decisions=decisions)


@query
def live_blocked_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.blocked_count(decided_payments(spark, sf_dir))


@query
def live_velocity_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.velocity_alerts(decided_payments(spark, sf_dir))


# The whole run


def batches_around_stream(spark: SparkSession, sf_dir: str, run: Callable[..., dict[str, DataFrame]] = batch.run_batch) -> dict[str, DataFrame]:
    """Gold tables of the second of two batches: the stream decides between them, and more settlement files come in."""
    lake, folder = new_lake(spark), new_folder(spark, "settlements")
    dated = F.date_add(F.col("executed_at").cast("date"), 2)
    settled = bank.raw_settlements(spark, sf_dir).withColumn("file_date", dated)
    early = F.col("file_date") < "2024-01-20"
    customers = bank.raw_customers(spark, sf_dir)
    payments = bank.velocity_payments(spark, sf_dir).select(*TRANSACTION_COLUMNS)
    sources = batch.Sources(customers, payments, folder, settlement_mode="incremental")
    exports.export_settlements(settled.filter(early), folder)
    run(lake, sources, bank.KEY, bank.RUN_TS - timedelta(minutes=30))
    files = events.file_events(spark, f"{sf_dir}/event[s].parquet", bank.EVENTS, files_per_trigger=None)
    job = live.start_velocity_job(bank.velocity_feed(files), customers, lake)
    job = job.option("checkpointLocation", new_folder(spark, "velocity-checkpoint"))
    job.trigger(availableNow=True).start().awaitTermination()
    exports.export_settlements(settled.filter(~early), folder)
    decided = replace(sources, decisions=lake.read_all("silver", "block_decisions"))
    return run(lake, decided, bank.KEY, bank.RUN_TS)


@query
def batch_facts_after_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches_around_stream(spark, sf_dir)["fct_transactions"]


@query
def batch_alerts_after_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches_around_stream(spark, sf_dir)["fct_daily_aml_alerts"]


@query
def incremental_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above, but the second batch rewrites only the months that changed."""
    return batches_around_stream(spark, sf_dir, incremental.run_incremental)["fct_transactions"]


@query
def incremental_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without ``detected_at``, which stays that of the first batch where nothing changed."""
    return batches_around_stream(spark, sf_dir, incremental.run_incremental)["fct_daily_aml_alerts"].drop("detected_at")


@query
def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers, written to a new lake; rows and amounts per gold table."""
    lake = new_lake(spark)
    folder = new_folder(spark, "settlements")
    settled = bank.raw_settlements(spark, sf_dir).withColumn(
        "file_date", F.date_add(F.col("executed_at").cast("date"), 2)
    )
    exports.export_settlements(settled, folder)
    sources = batch.Sources(
        bank.raw_customers(spark, sf_dir), bank.raw_transactions(spark, sf_dir), folder
    )
    gold = batch.run_batch(lake, sources, bank.KEY, bank.RUN_TS)
    parts = []
    for name, measure in [
        ("fct_transactions", F.sum("amount_eur")),
        ("fct_daily_aml_alerts", F.sum(marts.ROLLING)),
        ("snap_customers", F.lit(None)),
    ]:
        line = gold[name].agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            measure.cast("decimal(38,2)").alias("total"),
        )
        parts.append(line)
    return parts[0].unionByName(parts[1]).unionByName(parts[2])

