from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import timestamp_ntz
from ledgerwatch.operators import kpis
from ledgerwatch.operators.marts import ROLLING
from ledgerwatch.operators.quality import QualityError
from ledgerwatch.operators.upserts import apply_block_decisions
from ledgerwatch.plans import batch
from ledgerwatch.plans.batch import customer_history, update_customer_history
from ledgerwatch.schemas import BLOCK_DECISIONS
from ledgerwatch.sources import exports
from ledgerwatch.sources.lake import Lake
from testbed import bank

SMALL = "/root/testdata/sf0.001"
LATER = bank.RUN_TS + timedelta(minutes=30)


def sources(spark, folder):
    settled = bank.raw_settlements(spark, SMALL).withColumn(
        "file_date", F.date_add(F.col("executed_at").cast("date"), 2)
    )
    exports.export_settlements(settled, folder)
    return batch.Sources(bank.raw_customers(spark, SMALL), bank.raw_transactions(spark, SMALL), folder)


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_runs_repeat_and_history_advances(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    given = sources(spark, f"{tmp_path}/settlements")
    first = batch.run_batch(lake, given, bank.KEY, bank.RUN_TS)
    counts = {name: table.count() for name, table in first.items()}
    assert counts == {"fct_transactions": 997, "fct_daily_aml_alerts": 179, "snap_customers": 138}
    before = {name: spark.createDataFrame(t.collect(), t.schema) for name, t in first.items()}

    again = batch.run_batch(lake, given, bank.KEY, bank.RUN_TS)
    assert all(same(again[name], before[name]) for name in before)

    unchanged = batch.run_batch(lake, given, bank.KEY, LATER)
    assert same(unchanged["snap_customers"], before["snap_customers"])
    assert same(unchanged["fct_transactions"], before["fct_transactions"])

    moved = given.customers.withColumn(
        "city", F.when(F.col("risk_tier") == "PEP", "Elsewhere").otherwise(F.col("city"))
    )
    peps = moved.filter("risk_tier = 'PEP'").count()
    changed = batch.Sources(moved, given.transactions, given.settlement_folder)
    last = batch.run_batch(lake, changed, bank.KEY, LATER + timedelta(minutes=30))["snap_customers"]
    assert last.count() == 138 + peps
    assert last.filter("valid_to IS NOT NULL").count() == peps
    assert spark.table("stg_customers").filter("city = 'Elsewhere'").count() == peps


def test_blocks_reach_the_marts_in_the_next_run(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    given = sources(spark, f"{tmp_path}/settlements")
    ids = given.transactions.filter("status = 'PENDING'").select("transaction_id").limit(3)
    decisions = ids.select(
        "transaction_id",
        F.lit("VELOCITY_RULE: 5 INSTANT_SEPA in 60 min | risk_tier=PEP").alias("blocked_reason"),
        timestamp_ntz(bank.RUN_TS).alias("decided_at"),
    )
    decisions = spark.createDataFrame(decisions.collect(), decisions.schema)
    decided = apply_block_decisions(given.transactions, decisions)
    marts = batch.run_batch(
        lake, batch.Sources(given.customers, decided, given.settlement_folder), bank.KEY, bank.RUN_TS
    )
    facts = marts["fct_transactions"]
    assert facts.join(decisions, "transaction_id", "left_semi").select("final_status").distinct().collect() == [
        ("BLOCKED",)
    ]
    assert kpis.velocity_alerts(decided).count() == 3


def test_decisions_of_the_stream_are_laid_over_and_old_versions_go(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    given = sources(spark, f"{tmp_path}/settlements")
    ids = [r.transaction_id for r in given.transactions.filter("status = 'PENDING'").orderBy("transaction_id").limit(3).collect()]
    rows = [(i, "VELOCITY_RULE: a reason", bank.RUN_TS) for i in [*ids, "unknown"]]
    lake.write(spark.createDataFrame(rows, BLOCK_DECISIONS), "silver", "block_decisions", 0)
    blocked = replace(given, decisions=lake.read_all("silver", "block_decisions"))
    for later in range(3):
        run_ts = bank.RUN_TS + timedelta(minutes=30 * later)
        facts = batch.run_batch(lake, blocked, bank.KEY, run_ts, versions=2)["fct_transactions"]
    found = facts.filter(F.col("transaction_id").isin(ids)).select("final_status", "blocked_reason").collect()
    assert found == [("BLOCKED", "VELOCITY_RULE: a reason")] * 3
    assert facts.count() == 997
    kept = [("bronze", "raw_customers"), ("bronze", "raw_transactions"), ("bronze", "raw_settlements"), ("silver", batch.RECONCILED)]
    assert [len(lake.runs(*table)) for table in kept] == [2] * 4
    assert len(lake.runs("gold", "fct_transactions")) == 3 and len(lake.runs("silver", "block_decisions")) == 1
    assert customer_history(lake).count() == 138


def test_failed_check_stops_the_run_before_gold(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    given = sources(spark, f"{tmp_path}/settlements")
    bad = given.transactions.unionAll(given.transactions.limit(1))
    broken = batch.Sources(given.customers, bad, given.settlement_folder)
    with pytest.raises(QualityError, match="unique"):
        batch.run_batch(lake, broken, bank.KEY, bank.RUN_TS)
    assert lake.read("gold", "fct_transactions") is None


def test_empty_facts_have_no_rate(spark):
    empty = spark.createDataFrame([], "final_status string, risk_tier string, payment_channel string")
    assert kpis.kpi_totals(empty).first() == (0, 0, None)
    assert kpis.kpi_reconciliation(empty).isEmpty()
    assert kpis.kpi_fraud_breakdown(empty).isEmpty()


def test_alert_listing_can_hide_customers(spark):
    row = ("CODE", "t", "FR12****3456", "C1", "PEP", 1)
    names = f"rule_code string, transaction_id string, sender_iban_truncated string, customer_id string, risk_tier string, {ROLLING} int"
    alerts = spark.createDataFrame([row], names)
    assert kpis.alert_listing(alerts).first().customer_id == "C1"
    assert len(kpis.alert_listing(alerts, key="k").first().customer_id) == 64


def test_live_feed_is_a_top_k(spark):
    feed = kpis.live_feed(bank.raw_transactions(spark, SMALL), rows=5)
    assert feed.count() == 5
    assert "TakeOrderedAndProject" in feed._jdf.queryExecution().executedPlan().toString()


def history_run(lake, tier, run_ts):
    columns = "customer_id string, first_name string, last_name string, email string, phone_number string, iban string, address string, city string, country string, risk_tier string, created_at timestamp_ntz, ingested_at timestamp_ntz"
    row = ("C1", "f", "l", "e", "p", "FR7612345678901234567890123", "a", "c", "FR", tier, run_ts, run_ts)
    update_customer_history(lake, lake.spark.createDataFrame([row], columns), "k-test", run_ts)


def test_a_retried_run_replaces_what_it_closed(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    history_run(lake, "LOW", first)
    history_run(lake, "PEP", second)
    assert customer_history(lake).count() == 2
    history_run(lake, "LOW", second)
    assert [r.valid_to for r in customer_history(lake).collect()] == [None]


def test_a_run_that_breaks_off_leaves_the_history_as_it_was(spark, tmp_path, monkeypatch):
    lake = Lake(spark, f"{tmp_path}/lake")
    history_run(lake, "LOW", datetime(2024, 1, 1))
    write = Lake.write

    def break_off(self, df, layer, table, run):
        if table == batch.OPEN_VERSIONS:
            raise OSError("lost")
        return write(self, df, layer, table, run)

    monkeypatch.setattr(Lake, "write", break_off)
    with pytest.raises(OSError):
        history_run(lake, "PEP", datetime(2024, 1, 2))
    assert [r.valid_to for r in customer_history(lake).collect()] == [None]


def test_constraints_keep_broken_rows_out_of_a_run(spark, tmp_path):
    lake = Lake(spark, f"{tmp_path}/lake")
    given = sources(spark, f"{tmp_path}/settlements")
    clean = batch.run_batch(Lake(spark, f"{tmp_path}/clean"), given, bank.KEY, bank.RUN_TS)
    again = given.transactions.limit(5).withColumn("executed_at", F.col("executed_at") + F.expr("INTERVAL 1 DAY"))
    nameless = given.transactions.limit(4).withColumn("transaction_id", F.lit(None).cast("string"))
    broken = replace(given, transactions=given.transactions.unionByName(again).unionByName(nameless))
    gold = batch.run_batch(lake, broken, bank.KEY, bank.RUN_TS, constrain=True)
    for name in ("fct_transactions", "fct_daily_aml_alerts"):
        assert same(gold[name], clean[name])
    refused = lake.read(batch.QUARANTINE, "raw_transactions")
    assert {r["reason"]: r["count"] for r in refused.groupBy("reason").count().collect()} == {"unique(transaction_id)": 5, "not_null(transaction_id)": 4}
    assert lake.read(batch.QUARANTINE, "raw_customers").isEmpty()
