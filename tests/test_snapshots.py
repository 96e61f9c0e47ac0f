from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerwatch.operators.snapshots import as_of, empty_history, scd2_apply, scd2_history

T0 = datetime(2024, 1, 1)
ROW = "id string, tier string, city string, iban string"
CHECKS = ("tier", "city")


def sequential(batches):
    """Versions as (id, tier, city, iban, valid_from, valid_to), one run after the other."""
    versions, current = [], {}
    for run_ts, rows in batches:
        for key, tier, city, iban in rows:
            old = current.get(key)
            if old is None or (old[1], old[2]) != (tier, city):
                if old is not None:
                    old[5] = run_ts
                current[key] = [key, tier, city, iban, run_ts, None]
                versions.append(current[key])
    return sorted((tuple(v) for v in versions), key=str)


def random_batches(seed, keys=25, runs=8):
    rng = random.Random(seed)
    batches = []
    for run in range(runs):
        rows = [
            (f"c{k}", rng.choice(["LOW", "HIGH"]), rng.choice(["Paris", None]), f"iban{run}")
            for k in range(keys)
            if rng.random() < 0.7
        ]
        batches.append((T0 + timedelta(days=run), rows))
    return batches


def versions_of(history):
    rows = history.select("id", "tier", "city", "iban", "valid_from", "valid_to").collect()
    return sorted((tuple(r) for r in rows), key=str)


def run_all(spark, batches):
    history = empty_history(spark.createDataFrame([], ROW))
    for run_ts, rows in batches:
        history = scd2_apply(history, spark.createDataFrame(rows, ROW), "id", CHECKS, run_ts)
        history = spark.createDataFrame(history.collect(), history.schema)
    return history


def test_incremental_and_whole_history_match_sequential_snapshots(spark):
    batches = random_batches(1)
    flat = [(run_ts, *row) for run_ts, rows in batches for row in rows]
    whole = scd2_history(
        spark.createDataFrame(flat, f"run_ts timestamp_ntz, {ROW}"), "id", CHECKS, "run_ts"
    )
    incremental = run_all(spark, batches)
    expected = sequential(batches)
    assert len(expected) > 80
    assert versions_of(whole) == expected
    assert versions_of(incremental) == expected
    columns = whole.columns
    assert whole.exceptAll(incremental.select(*columns)).isEmpty()


def test_changes_that_open_a_version(spark):
    days = [T0 + timedelta(days=i) for i in range(6)]
    batches = [
        (days[0], [("c", "LOW", None, "i1")]),
        (days[1], [("c", "LOW", None, "i1")]),  # unchanged
        (days[2], [("c", "LOW", None, "i2")]),  # unchecked column only
        (days[3], []),  # missing
        (days[4], [("c", "LOW", None, "i2")]),  # back unchanged
        (days[5], [("c", "LOW", "Paris", "i3")]),  # NULL to a value
    ]
    assert versions_of(run_all(spark, batches)) == sorted(
        [("c", "LOW", None, "i1", days[0], days[5]), ("c", "LOW", "Paris", "i3", days[5], None)], key=str
    )


def test_unchanged_source_is_a_no_op(spark):
    rows = [(f"c{i}", "LOW", None, "i") for i in range(5)]
    once = run_all(spark, [(T0, rows)])
    again = scd2_apply(once, spark.createDataFrame(rows, ROW), "id", CHECKS, T0 + timedelta(days=1))
    assert again.select(*once.columns).exceptAll(once).isEmpty()
    assert again.count() == once.count()


def test_as_of_uses_half_open_intervals(spark):
    batches = [(T0, [("c", "LOW", "x", "i")]), (T0 + timedelta(days=10), [("c", "PEP", "x", "i")])]
    history = run_all(spark, batches)
    tick = timedelta(microseconds=1)
    change = T0 + timedelta(days=10)
    moments = [("before", T0 - tick), ("first", T0), ("last", change - tick), ("change", change), ("after", change + tick)]
    facts = spark.createDataFrame([(n, "c", t) for n, t in moments] + [("other", "z", T0)], "n string, id string, at timestamp_ntz")
    found = {r.n: r.asof_tier for r in as_of(facts, history, "id", F.col("at")).collect()}
    assert found == {"before": None, "first": "LOW", "last": "LOW", "change": "PEP", "after": "PEP", "other": None}
    assert as_of(facts, history, "id", F.col("at"), how="inner").count() == 4
