from __future__ import annotations

import heapq
import random
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.operators.upserts import apply_block_decisions
from ledgerwatch.operators.velocity import velocity_batch
from ledgerwatch.schemas import CUSTOMERS, TRANSACTION_COLUMNS, TRANSACTION_REQUIRED, VelocityRule
from ledgerwatch.sources import records
from ledgerwatch.sources.events import file_events
from ledgerwatch.sources.lake import Lake
from ledgerwatch.streaming import velocity as live
from ledgerwatch.streaming.counters import RunCounters, counted, counted_where
from ledgerwatch.streaming.sender_state import OUTPUT, SenderWindow, counts_in_arrival_order, still_counting
from testbed.queries import LandedFeed

T0 = datetime(2024, 1, 1, 12)
TEXT = T.StructType([T.StructField("value", T.StringType())])
TIERS = {"high": "HIGH", "pep": "PEP", "low": "LOW", "medium": "MEDIUM"}


def customers(spark):
    rows = [(f"C-{i}", "a", "b", "e", "p", i, "x", "y", "FR", tier, T0) for i, tier in TIERS.items()]
    return spark.createDataFrame(rows, CUSTOMERS)


def event(number, sender, at, channel="INSTANT_SEPA"):
    return (f"T{number:05}", sender, "FR1", "1,00", "EUR", channel, "PENDING", None, at, number)


SCHEMA = (
    "transaction_id string, sender_iban string, beneficiary_iban string, amount string, "
    "currency string, payment_channel string, status string, blocked_reason string, "
    "executed_at timestamp_ntz, arrival bigint"
)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def simulate(rows):
    """The rule, one event at a time, in arrival order."""
    windows, blocks = {}, {}
    for tid, sender, _, _, _, channel, _, _, at, _ in sorted(rows, key=lambda r: r[-1]):
        tier = TIERS.get(sender)
        if channel != "INSTANT_SEPA" or tier not in ("HIGH", "PEP"):
            continue
        kept = [t for t in [*windows.get(sender, []), at] if t > at - timedelta(minutes=60)]
        windows[sender] = kept
        if len(kept) >= 5:
            blocks[tid] = (
                len(kept),
                f"VELOCITY_RULE: {len(kept)} INSTANT_SEPA in 60 min | risk_tier={tier}",
            )
    return blocks


def random_events(seed, n=400, ordered=True):
    rng = random.Random(seed)
    times = [T0 + timedelta(seconds=rng.randrange(6 * 3600)) for _ in range(n)]
    if ordered:
        times.sort()
    senders = ["high"] * 5 + ["pep", "low", "medium", "stranger"]
    return [
        event(i, rng.choice(senders), at, rng.choice(["INSTANT_SEPA", "INSTANT_SEPA", "CARD"]))
        for i, at in enumerate(times)
    ]


def as_blocks(rows):
    return {r.transaction_id: (r.event_count, r.blocked_reason) for r in rows}


@pytest.fixture(autouse=True)
def keyed_state(spark):
    with live.rocksdb_state(spark):
        yield


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_batch_equals_simulation(spark, hot_rows):
    rows = random_events(1)
    found = velocity_batch(frame(spark, rows), customers(spark), arrival="arrival", hot_rows=hot_rows)
    expected = simulate(rows)
    assert len(expected) > 50
    assert as_blocks(found.collect()) == expected


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_window_is_open_on_the_left(spark, hot_rows):
    hour, tick = timedelta(minutes=60), timedelta(microseconds=1)
    rows = [event(i, "pep", T0) for i in range(4)]  # one time stamp, told apart by arrival
    rows += [event(4, "pep", T0 + hour - tick), event(5, "pep", T0 + hour)]
    rows += [event(6 + i, "high", T0 + timedelta(minutes=i)) for i in range(4)]
    rows += [event(20 + i, "low", T0) for i in range(9)] + [event(40 + i, "pep", T0, "CARD") for i in range(9)]
    found = velocity_batch(frame(spark, rows), customers(spark), arrival="arrival", hot_rows=hot_rows)
    assert {r.transaction_id: r.event_count for r in found.collect()} == {"T00004": 5}


@given(st.lists(st.integers(0, 200), max_size=60))
def test_state_step_follows_the_closed_form(times):
    """An arrival i counts at k unless an arrival in between was ``span`` or more newer."""
    span = 60
    expected = [
        sum(times[i] > max(times[i : k + 1]) - span for i in range(k + 1))
        for k in range(len(times))
    ]
    assert counts_in_arrival_order([], times, span) == expected


@given(st.lists(st.integers(0, 200), max_size=60), st.integers(0, 60))
def test_stored_arrivals_are_pruned_as_the_rule_drops_them(times, cut):
    """Dropping entries between micro-batches changes no later count."""
    span, stored = 60, np.array(times[:cut], dtype=np.int64)
    recent = counts_in_arrival_order([], times, span)
    kept = stored[still_counting(stored, span)].tolist() if len(stored) else []
    heapq.heapify(kept)
    assert counts_in_arrival_order(kept, times[cut:], span) == recent[cut:]


def land(spark, rows, folder):
    """One more file for the stream; file times decide the order, so they are kept apart."""
    frame(spark, rows).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(1.1)


def drain(writer, checkpoint):
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def decided(lake):
    return as_blocks(lake.read_all("silver", "block_decisions").collect())


@pytest.mark.parametrize("mode", ["exact", "bounded"])
def test_keyed_state_across_batches_and_a_restart(spark, tmp_path, mode):
    rows = random_events(2, 240)
    folder, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/checkpoint"
    lake = Lake(spark, f"{tmp_path}/lake")

    def run():
        feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
        stream = live.velocity_stream(feed, customers(spark), mode=mode)
        drain(live.decision_sink(stream, lake), checkpoint)

    for part in range(3):
        land(spark, rows[part * 40 : part * 40 + 40], folder)
    run()
    for part in range(3, 6):
        land(spark, rows[part * 40 : part * 40 + 40], folder)
    run()
    assert decided(lake) == simulate(rows)


def test_keyed_state_follows_arrival_order(spark, tmp_path):
    rows = random_events(3, 200, ordered=False)
    folder = f"{tmp_path}/feed"
    land(spark, rows[:100], folder)
    land(spark, rows[100:], folder)
    feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
    lake = Lake(spark, f"{tmp_path}/lake")
    stream = live.velocity_stream(counted(feed, "events"), customers(spark))
    totals = RunCounters()
    spark.streams.addListener(totals)
    drain(live.decision_sink(counted(stream, "blocked"), lake), f"{tmp_path}/checkpoint")
    expected = simulate(rows)
    assert expected and decided(lake) == expected
    deadline = time.time() + 20
    while totals["events"] < 200 and time.time() < deadline:
        time.sleep(0.2)
    spark.streams.removeListener(totals)
    assert (totals["events"], totals["blocked"]) == (200, len(expected))


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_distributed_job_across_batches_and_a_restart(spark, tmp_path, hot_rows):
    rows = random_events(4, 240)
    folder, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/checkpoint"
    lake = Lake(spark, f"{tmp_path}/lake")

    def run():
        feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
        drain(live.start_velocity_job(feed, customers(spark), lake, hot_rows=hot_rows), checkpoint)

    land(spark, rows[:80], folder)
    run()
    land(spark, rows[80:160], folder)
    land(spark, rows[160:], folder)
    run()
    assert decided(lake) == simulate(rows)
    tail = lake.read("silver", "block_decisions_tail")
    newest = max(r[-2] for r in rows if r[1] in ("high", "pep") and r[5] == "INSTANT_SEPA")
    oldest = tail.agg(F.min("executed_at")).first()[0]
    assert newest - timedelta(hours=2) < oldest


def test_json_feed_from_text_to_decisions(spark, tmp_path):
    """Decode, fill defaults, set faulty events aside, and decide on the others."""
    rows = random_events(5, 120)
    folder = f"{tmp_path}/feed"
    for part in (rows[:60], rows[60:]):
        encoded = records.encode_events(frame(spark, part)).select("value")
        broken = spark.createDataFrame([("{broken",), ('{"transaction_id":"x"}',)], "value string")
        encoded.unionByName(broken).coalesce(1).write.mode("append").text(folder)
        time.sleep(1.1)
    lake = Lake(spark, f"{tmp_path}/lake")

    def checked_feed():
        text = file_events(spark, folder, TEXT, files_per_trigger=1, file_format="text")
        filled = records.with_defaults(records.decode_events(text), records.TRANSACTION_DEFAULTS)
        return records.validate_records(
            filled, TRANSACTION_REQUIRED, records.TRANSACTION_DOMAINS, ["executed_at"]
        )

    valid, _ = checked_feed()
    stream = live.velocity_stream(valid, customers(spark), arrival="transaction_id")
    drain(live.decision_sink(stream, lake), f"{tmp_path}/decisions-checkpoint")
    _, quarantine = checked_feed()
    drain(live.decision_sink(quarantine, lake, "quarantine"), f"{tmp_path}/quarantine-checkpoint")

    expected = simulate(rows)
    assert expected and decided(lake) == expected
    assert lake.read_all("silver", "quarantine").count() == 4


def test_bounded_mode_forgets_idle_senders(spark, tmp_path):
    """The watermark moves on by the events of one sender and clears the other."""
    folder = f"{tmp_path}/feed"
    land(spark, [event(i, "pep", T0 + timedelta(minutes=i)) for i in range(3)], folder)
    for hour in range(2, 5):
        land(spark, [event(10 * hour, "high", T0 + timedelta(hours=4 * hour))], folder)
    lake = Lake(spark, f"{tmp_path}/lake")
    kept = {}
    for mode in ("exact", "bounded"):
        feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
        stream = live.velocity_stream(feed, customers(spark), mode=mode)
        writer = live.decision_sink(stream, lake, mode)
        query = writer.option("checkpointLocation", f"{tmp_path}/{mode}").trigger(availableNow=True).start()
        query.awaitTermination()
        last = [p["stateOperators"] for p in query.recentProgress if p["stateOperators"]][-1]
        kept[mode] = last[0]["numRowsTotal"]
    assert kept == {"exact": 2, "bounded": 1}


def test_replayed_events_can_be_dropped(spark, tmp_path):
    rows = [event(i, "pep", T0 + timedelta(minutes=i)) for i in range(4)]
    folder = f"{tmp_path}/feed"
    land(spark, rows, folder)
    land(spark, rows, folder)
    results = {}
    for name in ("as-is", "deduplicated"):
        feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
        if name == "deduplicated":
            feed = live.without_replays(feed)
        lake = Lake(spark, f"{tmp_path}/{name}")
        stream = live.velocity_stream(feed, customers(spark))
        drain(live.decision_sink(stream, lake), f"{tmp_path}/{name}-checkpoint")
        results[name] = sorted(r.event_count for r in lake.read_all("silver", "block_decisions").collect())
    # A redelivered event counts again, unless it is dropped before the rule.
    assert results["as-is"]
    assert results["deduplicated"] == []


def test_replayed_micro_batch_does_not_double_decisions(spark, tmp_path):
    rows = [event(i, "pep", T0 + timedelta(minutes=i)) for i in range(6)]
    lake = Lake(spark, f"{tmp_path}/lake")
    blocks = velocity_batch(frame(spark, rows), customers(spark), arrival="arrival")
    for _ in range(2):
        lake.write(blocks, "silver", "block_decisions", 7)
    assert lake.read_all("silver", "block_decisions").count() == 2


def test_decisions_reach_the_transactions(spark):
    rows = [event(i, "pep", T0 + timedelta(minutes=i)) for i in range(6)]
    payments = frame(spark, rows)
    decisions = velocity_batch(payments, customers(spark), arrival="arrival").withColumn(
        "decided_at", F.lit(T0).cast("timestamp_ntz")
    )
    after = apply_block_decisions(payments.select(*TRANSACTION_COLUMNS), decisions)
    blocked = {r.transaction_id for r in after.filter("status = 'BLOCKED'").collect()}
    assert blocked == {"T00004", "T00005"}
    assert after.count() == 6


def test_lookup_is_broadcast_only_when_small(spark):
    def plan(lookup):
        joined = spark.createDataFrame([("high",)], "sender_iban string").join(lookup, "sender_iban")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(live.start_lookup(customers(spark)))
    assert "strategy=broadcast" not in plan(live.start_lookup(customers(spark), max_rows=1))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        live.velocity_stream(frame(spark, []), customers(spark), mode="other")


def test_a_wrong_clock_does_not_shorten_the_others_windows(spark, tmp_path):
    folder, checkpoint = f"{tmp_path}/feed", f"{tmp_path}/checkpoint"
    lake = Lake(spark, f"{tmp_path}/lake")

    def run(rows):
        land(spark, rows, folder)
        feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
        drain(live.start_velocity_job(feed, customers(spark), lake), checkpoint)

    run([event(i, "pep", T0 + timedelta(minutes=i)) for i in range(4)] + [event(9, "high", T0 + timedelta(days=3000))])
    run([event(10, "pep", T0 + timedelta(minutes=5))])
    blocks = lake.read_all("silver", "block_decisions").collect()
    assert [(r.event_count, r.decided_at) for r in blocks] == [(5, T0 + timedelta(minutes=5))]


def test_a_new_checkpoint_is_refused_an_old_table(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    live.refuse_known_future(lake, "block_decisions", 0)
    lake.write(spark.range(1), "silver", "block_decisions", 4)
    live.refuse_known_future(lake, "block_decisions", 4)
    with pytest.raises(RuntimeError):
        live.refuse_known_future(lake, "block_decisions", 0)


def test_the_sessions_state_store_is_put_back(spark):
    spark.conf.set(live.PROVIDER, "other")
    try:
        with pytest.raises(RuntimeError):
            live.velocity_stream(frame(spark, []), customers(spark))
        with live.rocksdb_state(spark):
            assert spark.conf.get(live.PROVIDER) == live.ROCKSDB
        assert spark.conf.get(live.PROVIDER) == "other"
    finally:
        spark.conf.set(live.PROVIDER, live.ROCKSDB)


def test_late_events_are_kept_apart_and_counted(spark, tmp_path):
    """Behind the newest event of earlier micro-batches by more than the delay, whoever's it was."""
    folder, lake = f"{tmp_path}/feed", Lake(spark, f"{tmp_path}/lake")
    minute = lambda k: T0 + timedelta(minutes=k)
    land(spark, [event(0, "high", minute(100)), event(1, "pep", minute(89)), event(2, "pep", minute(20))], folder)
    land(spark, [event(3, "pep", minute(90)), event(4, "pep", minute(91)), event(5, "stranger", minute(1)), event(6, "pep", None)], folder)
    feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
    totals = RunCounters()
    spark.streams.addListener(totals)
    stream = live.judged_stream(feed, customers(spark), VelocityRule(max_transactions=1), "bounded", delay="10 minutes")
    stream = counted_where(stream, {"late": F.col("late"), "in time": ~F.col("late")})
    writer = live.decision_sink(stream, lake).option("checkpointLocation", f"{tmp_path}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    counts = totals.of_run(query)
    spark.streams.removeListener(totals)
    rows = {r.transaction_id: r.event_count for r in lake.read_all("silver", "block_decisions").collect()}
    assert rows == {"T00000": 1, "T00001": 1, "T00002": 2, "T00004": 2}
    assert [tuple(r) for r in lake.read_all("silver", "block_decisions_late").collect()] == [("T00003", minute(90))]
    assert counts == {"late": 1, "in time": 4}


def test_state_is_added_to_and_pruned(spark, tmp_path):
    """A sender's list never holds much more than twice what still counts."""
    folder, lake = f"{tmp_path}/feed", Lake(spark, f"{tmp_path}/lake")
    for part in range(5):
        land(spark, [event(part * 20 + k, "pep", T0 + timedelta(minutes=40 * part + 2 * k)) for k in range(20)], folder)
    feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
    writer = live.decision_sink(live.velocity_stream(feed, customers(spark)), lake).option("checkpointLocation", f"{tmp_path}/checkpoint")
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(held) >= 5 and max(held) <= 80
    assert decided(lake) == simulate([event(k, "pep", T0 + timedelta(minutes=2 * k)) for k in range(100)])


def test_idle_senders_leave_the_tail(spark, tmp_path):
    folder, lake = f"{tmp_path}/feed", Lake(spark, f"{tmp_path}/lake")
    rows = [(f"C-{i}", "a", "b", "e", "p", i, "x", "y", "FR", "HIGH", T0) for i in "abcd"]
    owners = spark.createDataFrame(rows, CUSTOMERS)
    for part in range(3):
        senders = "abcd" if part == 0 else "abc"
        land(spark, [event(10 * part + k, s, T0 + timedelta(hours=3 * part, minutes=k)) for k, s in enumerate(senders)], folder)
    feed = file_events(spark, folder, frame(spark, []).schema, files_per_trigger=1)
    drain(live.start_velocity_job(feed, owners, lake), f"{tmp_path}/checkpoint")
    tail = lake.read("silver", "block_decisions_tail")
    assert {r.sender_iban for r in tail.collect()} == {"a", "b", "c"}


def test_a_sender_with_nothing_to_tell_costs_no_frame_and_one_timer():
    """Frames and timers are written only where they say something; a timer that comes early is set again."""

    class Entries:
        def __init__(self):
            self.rows = []

        def exists(self):
            return bool(self.rows)

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):
            self.rows += rows

        def clear(self):
            self.rows = []

    class Handle:
        timers: list[int] = []
        listTimers = lambda self: iter(list(self.timers))
        getListState = lambda self, name, schema: Entries()

        def registerTimer(self, at):
            self.timers.append(at)

        def deleteTimer(self, at):
            self.timers.remove(at)

    class Now:
        getCurrentWatermarkInMs = getExpiryTimeInMs = lambda self: 0

    minute = 60_000_000
    window, handle = SenderWindow(3, 60 * minute, bounded=True), Handle()
    window.init(handle)
    rows = lambda *at: iter([pd.DataFrame({"transaction_id": [f"t{m}" for m in at], "sender_iban": "a", "risk_tier": "LOW", "at_micros": [m * minute for m in at], "arrival": at})])
    assert list(window.handleInputRows(("a",), rows(5), Now())) == []
    assert list(window.handleInputRows(("a",), rows(20), Now())) == []
    assert handle.timers == [65 * 60_000 + 1]
    (out,) = window.handleInputRows(("a",), rows(31, 30), Now())
    assert list(out.columns) == OUTPUT.fieldNames()
    assert out[["transaction_id", "event_count", "late"]].values.tolist() == [["t30", 3, False], ["t31", 4, False]]
    early = type("Expired", (), {"getExpiryTimeInMs": lambda self: handle.timers[0]})()
    handle.timers = [65 * 60_000 + 1]
    assert list(window.handleExpiredTimer(("a",), Now(), early)) == []
    assert handle.timers[-1] == 91 * 60_000 + 1 and len(window.state.rows) == 4
    last = type("Expired", (), {"getExpiryTimeInMs": lambda self: 91 * 60_000 + 1})()
    assert list(window.handleExpiredTimer(("a",), Now(), last)) == [] and not window.state.rows


def test_landed_files_grow_with_the_feed(spark, monkeypatch):
    monkeypatch.setattr(LandedFeed, "FILE_ROWS", 1000, raising=False)
    feed = LandedFeed(spark.range(60_000).selectExpr("id arrival", "cast(id % 6 as int) slice"))
    feed.land(*range(6))
    landed = spark.read.parquet(feed.folder)
    assert landed.count() == 60_000 and len(landed.inputFiles()) == 6 * 10
