from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators.marts import ROLLING, aml_alerts, rolling_cross_border
from ledgerwatch.operators import sliding
from ledgerwatch.operators.sliding import hot_keys, sliding_totals
from ledgerwatch.workspace import stage

T0 = datetime(2024, 1, 1)


def random_rows(seed: int, n: int, spread: int):
    """Few keys, one of them with a third of all rows, and many equal times."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else rng.choice("abcdef")
        at = T0 + timedelta(seconds=rng.randrange(spread))
        if rng.random() < 0.2:
            at += timedelta(microseconds=rng.randrange(3))
        rows.append((i, key, at, Decimal(rng.randrange(-500, 1000)) / 100))
    return rows


def brute_force(rows, span: timedelta, ties: bool):
    totals = {}
    for i, key, at, _ in rows:
        total = Decimal(0)
        for j, other, time, value in rows:
            before = (time, j) <= (at, i) if ties else time <= at
            if other == key and before and time > at - span:
                total += value
        totals[i] = total
    return totals


@pytest.mark.parametrize("range_rows", [7, 60, 10**6])
@pytest.mark.parametrize("hot_rows", [1, 60, 10**9])
@pytest.mark.parametrize("ties", [False, True])
def test_matches_brute_force(spark, range_rows, hot_rows, ties):
    span = timedelta(minutes=20)
    rows = random_rows(7, 300, 7200)
    frame = spark.createDataFrame(rows, "i int, k string, at timestamp_ntz, v decimal(18,2)")
    found = sliding_totals(
        frame,
        "k",
        "at",
        {"total": F.col("v"), "n": F.lit(1).cast("bigint")},
        span,
        tie_break="i" if ties else None,
        hot_rows=hot_rows,
        range_rows=range_rows,
    ).collect()
    expected = brute_force(rows, span, ties)
    assert len(found) == len(rows)
    assert {row.i: row.total for row in found} == expected
    one = [(i, k, at, Decimal(1)) for i, k, at, _ in rows]
    assert {row.i: row.n for row in found} == {
        i: int(v) for i, v in brute_force(one, span, ties).items()
    }


def test_coarse_times_of_a_hot_key_are_summed_before_the_shuffle(spark):
    """All rows of one key fall on three dates."""
    rng = random.Random(11)
    rows = [
        (i, "hot" if i % 3 else "cold", T0 + timedelta(days=rng.randrange(3) * 20), Decimal(i))
        for i in range(200)
    ]
    frame = spark.createDataFrame(rows, "i int, k string, at timestamp_ntz, v decimal(18,2)")
    span = timedelta(days=30)
    result = sliding_totals(frame, "k", "at", {"total": F.col("v")}, span, hot_rows=100)
    assert {row.i: row.total for row in result.collect()} == brute_force(rows, span, False)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "keys=[k#" in plan and "partial_sum" in plan


def test_a_single_second_of_a_hot_key_is_cut(spark):
    """All rows have one key and one time: each group of the last window still has about as many as asked for."""
    rows = [(i, "hot", T0, Decimal(i)) for i in range(2_000)]
    frame = spark.createDataFrame(rows, "i int, k string, at timestamp_ntz, v decimal(18,2)")
    total, staged = {"total": F.col("v")}, []

    def seen(df, label):
        staged.append(stage(df, label))
        return staged[-1]

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sliding, "stage", seen)
        result = sliding_totals(frame, "k", "at", total, timedelta(minutes=5), tie_break="i", hot_rows=1, range_rows=200)
    assert {r.i: r.total for r in result.collect()} == {i: Decimal(i * (i + 1) // 2) for i in range(2_000)}
    sizes = [r["count"] for r in staged[0].groupBy("k", "_range").count().collect()]
    assert len(sizes) == 20 and max(sizes) <= 3 * 200


def test_known_small_input_takes_the_plain_way(spark):
    rows = random_rows(3, 50, 3600)
    frame = spark.createDataFrame(rows, "i int, k string, at timestamp_ntz, v decimal(18,2)")
    plan = sliding_totals(
        frame, "k", "at", {"t": F.col("v")}, timedelta(hours=1), rows=50
    )._jdf.queryExecution().toString()
    assert "Union" not in plan


def test_hot_keys_are_the_largest_and_bounded(spark):
    frame = spark.range(100).select(F.when(F.col("id") < 50, "x").when(F.col("id") < 80, "y").otherwise("z").alias("k"))
    assert {r.k for r in hot_keys(frame, "k", 25).collect()} == {"x", "y"}
    assert [r.k for r in hot_keys(frame, "k", 1, limit=1).collect()] == ["x"]


PAYMENT = (
    "transaction_id string, sender_iban_hmac string, sender_iban_truncated string, "
    "amount_eur decimal(18,2), executed_at timestamp_ntz, is_cross_border boolean, final_status string"
)


def payment(tid, at, amount, sender="s1", cross=True, status="SETTLED"):
    value = None if amount is None else Decimal(amount)
    return (tid, sender, "FR**", value, at, cross, status)


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_alert_window_edges(spark, hot_rows):
    base = datetime(2024, 3, 1, 12)
    month = timedelta(days=30)
    tick = timedelta(microseconds=1)
    rows = spark.createDataFrame(
        [
            payment("exactly-30-days", base - month, "1.00", "edge"),
            payment("just-too-old", base - month - tick, "2.00", "edge"),
            payment("now", base, "4.00", "edge"),
            payment("same-time", base, "8.00", "edge"),
            payment("later", base + tick, "16.00", "edge"),
            payment("blocked", base, "32.00", "edge", status="BLOCKED"),
            payment("at-home", base, "64.00", "edge", cross=False),
            payment("unknown-flag", base, "64.00", "edge", cross=None),
            payment("no-status", base, "64.00", "edge", status=None),
            payment("no-sender", base, "128.00", None),
            payment("no-sender-2", base, "128.00", None),
            payment("no-time", None, "256.00", "edge"),
            payment("no-amount", base, None, "void"),
            payment("no-amount-here", base, None, "edge"),
        ],
        PAYMENT,
    )
    found = {
        r.transaction_id: r[ROLLING]
        for r in rolling_cross_border(rows, hot_rows=hot_rows).collect()
    }
    assert found == {
        "just-too-old": Decimal("2.00"),
        "exactly-30-days": Decimal("3.00"),
        "now": Decimal("13.00"),
        "same-time": Decimal("13.00"),
        "no-amount-here": Decimal("13.00"),
        # Exactly 30 days before this one lies nothing: the oldest is a tick too old.
        "later": Decimal("28.00"),
        "no-amount": None,
    }


def test_alert_threshold_is_strict(spark):
    rows = spark.createDataFrame(
        [
            payment("at", T0, "10000.00", "a"),
            payment("above", T0, "10000.01", "b"),
            payment("half", T0, "6000.00", "c"),
            payment("sum", T0 + timedelta(days=3), "5000.00", "c"),
        ],
        PAYMENT,
    )
    owners = spark.createDataFrame(
        [("b", "C1", "PEP")], "iban_hmac string, customer_id string, risk_tier string"
    )
    found = {r.transaction_id: r for r in aml_alerts(rows, owners, T0).collect()}
    assert set(found) == {"above", "sum"}
    assert (found["above"].customer_id, found["above"].risk_tier) == ("C1", "PEP")
    assert found["sum"].customer_id is None
    assert found["sum"].rule_code == "CUMULATIVE_CROSS_BORDER_10K"
    assert found["sum"].detected_at == T0


@pytest.mark.parametrize("hot_rows", [1, 10**6])
def test_copies_count_as_the_grouped_self_join_counts_them(spark, hot_rows):
    rng = random.Random(5)
    distinct = [
        payment(f"t{i}", T0 + timedelta(days=rng.randrange(90)), rng.randrange(1, 50), rng.choice("ab"))
        for i in range(40)
    ]
    rows = distinct + [row for row in distinct if rng.random() < 0.4]
    frame = spark.createDataFrame(rows, PAYMENT)
    frame.createOrReplaceTempView("copies")
    expected = spark.sql(
        """SELECT a.transaction_id, sum(b.amount_eur) AS total FROM copies a JOIN copies b
           ON a.sender_iban_hmac = b.sender_iban_hmac
           AND b.executed_at BETWEEN a.executed_at - INTERVAL 30 DAYS AND a.executed_at
           GROUP BY a.transaction_id, a.amount_eur, a.executed_at"""
    ).collect()
    found = rolling_cross_border(frame, hot_rows=hot_rows, merge_copies=True).collect()
    assert {r.transaction_id: r[ROLLING] for r in found} == {r[0]: r[1] for r in expected}
    assert len(found) == len(distinct)
