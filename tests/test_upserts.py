from __future__ import annotations

import random
from datetime import datetime

import pytest

from ledgerwatch.operators.upserts import (
    absent_rows,
    apply_block_decisions,
    first_per_key,
    insert_absent,
    last_per_key,
)
from ledgerwatch.schemas import BLOCK_DECISIONS

ROWS = "a string, b string, payload string, arrival int"


def one_by_one(target, incoming, keys):
    """Insert in arrival order, skipping a row that conflicts in any key."""
    taken = [{row[k] for row in target} for k in keys]
    added = []
    for row in sorted(incoming, key=lambda r: r[3]):
        if all(row[k] not in values for k, values in zip(keys, taken)):
            added.append(row)
            for k, values in zip(keys, taken):
                values.add(row[k])
    return added


@pytest.mark.parametrize("seed", range(3))
def test_two_keys_match_inserting_one_by_one(spark, seed):
    rng = random.Random(seed)
    # A third of the rows share one value, and short ranges make long conflict chains.
    def row(i):
        a = "hot" if rng.random() < 0.33 else f"a{rng.randrange(40)}"
        return (a, f"b{rng.randrange(40)}", f"p{i}", i)

    target = [(f"a{i}", f"b{i}", "old", -1 - i) for i in range(3)]
    incoming = [row(i) for i in range(150)]
    found = absent_rows(
        spark.createDataFrame(target, ROWS),
        spark.createDataFrame(incoming, ROWS),
        [["a"], ["b"]],
        "arrival",
    )
    assert sorted(map(tuple, found.collect())) == sorted(one_by_one(target, incoming, [0, 1]))


def test_row_that_lost_only_to_a_skipped_row_is_added(spark):
    incoming = [("a1", "b1", "x", 0), ("a2", "b1", "skipped", 1), ("a2", "b2", "y", 2), ("a3", "b2", "z", 3)]
    empty = spark.createDataFrame([], ROWS)
    found = absent_rows(empty, spark.createDataFrame(incoming, ROWS), [["a"], ["b"]], "arrival")
    assert sorted(r.payload for r in found.collect()) == ["x", "y"]


def test_nothing_incoming(spark):
    empty = spark.createDataFrame([], ROWS)
    target = spark.createDataFrame([("a", "b", "p", 0)], ROWS)
    for keys in ([["a"]], [["a"], ["b"]]):
        assert insert_absent(target, empty, keys, "arrival").count() == 1


def test_replay_keeps_the_first_write(spark):
    target = spark.createDataFrame([("a1", "b", "old", 0)], ROWS)
    incoming = [("a1", "b", "replay", 1), ("a2", "b", "first", 2), ("a2", "b", "replay", 3)]
    after = insert_absent(target, spark.createDataFrame(incoming, ROWS), [["a"]], "arrival")
    assert sorted((r.a, r.payload) for r in after.collect()) == [("a1", "old"), ("a2", "first")]


def test_first_and_last_reduce_before_the_shuffle(spark):
    frame = spark.createDataFrame([("k", "b", None, 2), ("k", "b", "z", 1), ("m", "b", "q", 5)], ROWS)
    assert {(r.a, r.arrival) for r in first_per_key(frame, ["a"], ["arrival"]).collect()} == {("k", 1), ("m", 5)}
    last = last_per_key(frame, ["a"], ["arrival"])
    assert {(r.a, r.payload) for r in last.collect()} == {("k", None), ("m", "q")}
    assert last.columns == frame.columns
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan[plan.index("Exchange") :]


def test_block_decisions(spark):
    rows = [("t1", "PENDING", None), ("t2", "SETTLED", None), ("t3", "BLOCKED", "MANUAL"), ("t4", "PENDING", None)]
    transactions = spark.createDataFrame(rows, "transaction_id string, status string, blocked_reason string")
    day = lambda n: datetime(2024, 1, n)
    decisions = spark.createDataFrame(
        [("t1", "late", day(3)), ("t1", "early", day(2)), ("t2", "r", day(1)), ("t3", "again", day(1)), ("t9", "r", day(1))],
        BLOCK_DECISIONS,
    )
    after = {r.transaction_id: (r.status, r.blocked_reason) for r in apply_block_decisions(transactions, decisions).collect()}
    assert after == {
        "t1": ("BLOCKED", "late"),
        "t2": ("BLOCKED", "r"),
        "t3": ("BLOCKED", "again"),
        "t4": ("PENDING", None),
    }


@pytest.mark.parametrize("keys", [[["a"]], [["a"], ["b"]]])
def test_null_keys_conflict_with_nothing(spark, keys):
    target = spark.createDataFrame([(None, "b0", "old", -1)], ROWS)
    rows = [(None, None, "p", 0), (None, None, "p", 1), ("x", None, "p", 2), ("x", "b1", "p", 3), (None, "b2", "p", 4), ("y", "b3", "p", 5)]
    added = absent_rows(target, spark.createDataFrame(rows, ROWS), keys, "arrival")
    assert sorted(r.arrival for r in added.collect()) == [0, 1, 2, 4, 5]


def test_no_endless_rounds_without_an_arrival(spark):
    rows = spark.createDataFrame([("a", "b", "p", None), ("a", "c", "p", None)], ROWS)
    with pytest.raises(ValueError):
        absent_rows(rows.limit(0), rows, [["a"], ["b"]], "arrival").collect()
