from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from ledgerwatch.plans import batch, incremental
from ledgerwatch.operators.quality import QualityError
from ledgerwatch.schemas import CrossBorderRule
from ledgerwatch.sources import exports, months
from ledgerwatch.sources.lake import Lake, run_id
from testbed import bank

SMALL = "/root/testdata/sf0.001"
FIRST, SECOND, THIRD = (bank.RUN_TS + timedelta(minutes=30 * i) for i in range(3))
MARTS = ("fct_transactions", "fct_daily_aml_alerts")
RULE = CrossBorderRule()


@pytest.fixture
def given(spark, tmp_path):
    """Payments of about 6,000 euro spread over seven months, so that windows cross months and some months are out of reach."""
    number = F.pmod(F.xxhash64("transaction_id"), F.lit(1000)).cast("string")
    amount = F.concat(F.lit("6."), F.lpad(number, 3, "0"), F.lit(",00"))
    spread = F.col("executed_at") + F.make_interval(days=F.pmod(F.xxhash64("transaction_id"), F.lit(200)).cast("int"))
    live = bank.raw_transactions(spark, SMALL).withColumns({"executed_at": spread, "amount": amount})
    settled = bank.raw_settlements(spark, SMALL).withColumns({"executed_at": spread, "amount": amount})
    exports.export_settlements(settled.withColumn("file_date", F.lit("2024-01-20").cast("date")), f"{tmp_path}/settled")
    live.write.parquet(f"{tmp_path}/live")
    return batch.Sources(bank.raw_customers(spark, SMALL), spark.read.parquet(f"{tmp_path}/live"), f"{tmp_path}/settled")


def assert_same_as_full(spark, folder, given, gold, run_ts, rule=RULE):
    full = batch.run_batch(Lake(spark, folder), given, bank.KEY, run_ts, rule)
    for name in MARTS:
        left, right = (t[name].drop("detected_at") for t in (full, gold))
        right = right.select(*left.columns)
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    return full


def held(lake, table):
    return months.read_state(lake, incremental.STATE)[table]


def test_only_months_in_reach_of_a_change_are_rewritten(spark, tmp_path, given):
    lake = Lake(spark, f"{tmp_path}/lake")
    gold = incremental.run_incremental(lake, given, bank.KEY, FIRST, RULE)
    full = assert_same_as_full(spark, f"{tmp_path}/full0", given, gold, FIRST)
    assert full["fct_daily_aml_alerts"].count() > 50
    every = sorted(held(lake, incremental.FACTS))
    assert len(every) >= 6

    # A cross-border payment in the middle is blocked, and its amount changes.
    alerts = gold["fct_daily_aml_alerts"]
    some = alerts.where(months.month_of("executed_at") == every[2]).orderBy("transaction_id").first()
    hit = F.col("transaction_id") == some["transaction_id"]
    moved = given.transactions.withColumn("amount", F.when(hit, F.lit("0,01")).otherwise(F.col("amount")))
    moved = moved.withColumn("status", F.when(hit, F.lit("BLOCKED")).otherwise(F.col("status")))
    changed = replace(given, transactions=moved)
    gold = incremental.run_incremental(lake, changed, bank.KEY, SECOND, RULE)
    full = assert_same_as_full(spark, f"{tmp_path}/full1", changed, gold, SECOND)
    second = run_id(SECOND)
    assert [m for m in every if held(lake, incremental.FACTS)[m] == second] == [every[2]]
    acted = {m for m, run in held(lake, incremental.ALERTS).items() if run == second}
    assert acted <= {every[2], every[3]} and acted
    again = gold["fct_daily_aml_alerts"].where(F.col("sender_iban_hmac") != some["sender_iban_hmac"])
    assert [r[0] for r in again.select("detected_at").distinct().collect()] == [FIRST]

    # The same again changes nothing and writes no month.
    gold = incremental.run_incremental(lake, changed, bank.KEY, THIRD, RULE, versions=1)
    assert_same_as_full(spark, f"{tmp_path}/full2", changed, gold, THIRD)
    assert run_id(THIRD) not in set(held(lake, incremental.FACTS).values()) | set(held(lake, incremental.ALERTS).values())
    assert lake.runs("gold", incremental.STATE) == [run_id(THIRD)]


def test_moved_missing_and_repeated_rows(spark, tmp_path, given):
    """A payment moves to another month, one goes, settlements come late, and rows without id and time come twice."""
    lake = Lake(spark, f"{tmp_path}/lake")
    incremental.run_incremental(lake, given, bank.KEY, FIRST, RULE, check=False)
    named = given.transactions.orderBy("transaction_id")
    ids = [r[0] for r in named.select("transaction_id").limit(2).collect()]
    is_ = [F.col("transaction_id") == i for i in ids]
    at = F.when(is_[0], F.col("executed_at") + F.expr("INTERVAL 70 DAYS")).otherwise(F.col("executed_at"))
    rows = given.transactions.withColumn("executed_at", at).where(~is_[1])
    nothing = {"transaction_id": F.lit(None).cast("string"), "executed_at": F.lit(None).cast("timestamp_ntz")}
    nameless = named.limit(2).withColumns(nothing)
    late = given.transactions.where("transaction_id like '%7'").withColumn("file_date", F.lit("2024-03-01").cast("date"))
    changed = replace(given, transactions=rows.unionByName(nameless).unionByName(nameless))
    exports.export_settlements(late, given.settlement_folder)
    gold = incremental.run_incremental(lake, changed, bank.KEY, SECOND, RULE, check=False)
    full = batch.run_batch(Lake(spark, f"{tmp_path}/full"), changed, bank.KEY, SECOND, RULE, check=False)
    for name in MARTS:
        left, right = (t[name].drop("detected_at") for t in (full, gold))
        assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
    assert months.NO_MONTH in held(lake, incremental.FACTS)


def test_a_changed_customer_reaches_all_own_rows(spark, tmp_path, given):
    lake = Lake(spark, f"{tmp_path}/lake")
    incremental.run_incremental(lake, given, bank.KEY, FIRST, RULE)
    tier = F.when(F.col("risk_tier") == "PEP", "LOW").otherwise(F.col("risk_tier"))
    changed = replace(given, customers=given.customers.withColumn("risk_tier", tier))
    gold = incremental.run_incremental(lake, changed, bank.KEY, SECOND, RULE)
    assert gold["fct_transactions"].where("risk_tier = 'PEP'").isEmpty()
    assert_same_as_full(spark, f"{tmp_path}/full", changed, gold, SECOND)


def test_another_rule_computes_everything_and_a_failed_run_leaves_the_old_state(spark, tmp_path, given):
    lake = Lake(spark, f"{tmp_path}/lake")
    incremental.run_incremental(lake, given, bank.KEY, FIRST, RULE)
    other = replace(RULE, days=20)
    gold = incremental.run_incremental(lake, given, bank.KEY, SECOND, other)
    assert_same_as_full(spark, f"{tmp_path}/full", given, gold, SECOND, other)
    before = months.read_state(lake, incremental.STATE)
    broken = replace(given, transactions=given.transactions.unionAll(given.transactions.limit(1)))
    with pytest.raises(QualityError, match="unique"):
        incremental.run_incremental(lake, broken, bank.KEY, THIRD, other)
    assert months.read_state(lake, incremental.STATE) == before
