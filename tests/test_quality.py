from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest

from ledgerwatch.operators import quality as q
from ledgerwatch.operators.marts import ROLLING
from ledgerwatch.plans import declared
from testbed import bank, queries

SMALL = "/root/testdata/sf0.001"
TABLES = {
    "stg_transactions": (queries.stg_tx, declared.STG_TRANSACTIONS),
    "stg_customers": (queries.stg_cust, declared.STG_CUSTOMERS),
    "fct_transactions": (queries.facts, declared.FCT_TRANSACTIONS),
    "fct_daily_aml_alerts": (queries.aml_alerts, declared.AML_ALERTS),
}


def test_number_of_declared_checks():
    assert sum(len(checks) for _, checks in TABLES.values()) == 25
    source = declared.SOURCE_CUSTOMERS + declared.SOURCE_TRANSACTIONS
    assert sum(check.kind in ("unique", "not_null") for check in source) == 17


@pytest.mark.parametrize("table", list(TABLES))
def test_clean_tables_pass_the_gate(spark, table):
    build, checks = TABLES[table]
    report = q.run_checks(build(spark, SMALL), checks, table)
    assert report.count() == len(checks)
    assert report.filter("failures <> 0").isEmpty()


def test_source_tables_pass(spark):
    q.run_checks(bank.raw_customers(spark, SMALL), declared.SOURCE_CUSTOMERS)
    q.run_checks(bank.raw_transactions(spark, SMALL), declared.SOURCE_TRANSACTIONS)


# One bad row per check, as (column, bad value); a second row repeats the first key.
PLANTED = {
    "unique(transaction_id)": {},
    "not_null(transaction_id)": {"transaction_id": None},
    "not_null(sender_iban_hmac)": {"sender_iban_hmac": None},
    "length(sender_iban_hmac)": {"sender_iban_hmac": "abc"},
    "not_null(amount_eur)": {"amount_eur": None},
    "between(amount_eur)": {"amount_eur": Decimal("-0.01")},
    "accepted(status)": {"status": "LOST"},
    "not_null(final_status)": {"final_status": None},
    "accepted(final_status)": {"final_status": "LOST"},
    "accepted(payment_channel)": {"payment_channel": "CHEQUE"},
    "accepted(currency)": {"currency": "USD"},
    "not_null(rule_code)": {"rule_code": None},
    "accepted(rule_code)": {"rule_code": "OTHER"},
    f"not_null({ROLLING})": {ROLLING: None},
    f"between({ROLLING})": {ROLLING: Decimal("9999.99")},
    "unique(customer_id)": {},
    "not_null(customer_id)": {"customer_id": None},
    "unique(iban_hmac)": {},
    "not_null(iban_hmac)": {"iban_hmac": None},
    "accepted(risk_tier)": {"risk_tier": "NONE"},
}
GOOD = {
    "transaction_id": "t1",
    "sender_iban_hmac": "0" * 64,
    "amount_eur": Decimal("0.00"),
    "status": "PENDING",
    "final_status": "SETTLED",
    "payment_channel": "SEPA",
    "currency": "EUR",
    "rule_code": "CUMULATIVE_CROSS_BORDER_10K",
    ROLLING: Decimal("10000.00"),
    "customer_id": "c1",
    "iban_hmac": "h",
    "risk_tier": "PEP",
}
SCHEMA = ", ".join(
    f"{name} {'decimal(28,2)' if isinstance(value, Decimal) else 'string'}" for name, value in GOOD.items()
)
ALL = {check.name: check for _, checks in TABLES.values() for check in checks}


@pytest.mark.parametrize("name", list(ALL))
def test_each_check_fails_on_a_planted_row(spark, name):
    check = ALL[name]
    good = spark.createDataFrame([tuple(GOOD.values())], SCHEMA)
    q.run_checks(good, [check])
    if check.kind == "row_count":
        bad = good.limit(0)
    elif check.kind == "unique":
        bad = good.unionAll(good)
    else:
        bad = spark.createDataFrame([tuple({**GOOD, **PLANTED[name]}.values())], SCHEMA)
    with pytest.raises(q.QualityError, match="failed 1 checks"):
        q.run_checks(bad, [check])


def test_null_passes_value_checks(spark):
    nothing = spark.createDataFrame([(None,) * len(GOOD)], SCHEMA)
    assert q.check_accepted(nothing, "status", ["PENDING"]).isEmpty()
    assert q.check_length(nothing, "sender_iban_hmac", 64).isEmpty()
    assert q.check_between(nothing, "amount_eur", low=0).isEmpty()
    assert q.check_unique(nothing.unionAll(nothing), "transaction_id").isEmpty()
    assert q.check_not_null(nothing, "status").count() == 1


def test_bounds_are_inclusive(spark):
    rows = spark.createDataFrame([(n,) for n in range(5)], "n int")
    assert [r.n for r in q.check_between(rows, "n", low=1, high=3).orderBy("n").collect()] == [0, 4]
    assert q.check_row_count(rows, low=5, high=5).isEmpty()
    assert q.check_row_count(rows, low=6).first().n_rows == 5
    assert q.check_row_count(rows, high=4).first().n_rows == 5


def test_report_scans_the_table_once_for_all_row_checks(spark):
    rows = bank.dirty_payments(spark, SMALL)
    checks = [c for c in declared.STG_TRANSACTIONS if c.kind != "unique"]
    plan = q.check_report(rows, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_quarantine_keeps_every_row(spark):
    rows = bank.dirty_payments(spark, SMALL)
    checks = [c for c in declared.STG_TRANSACTIONS if c.kind != "unique"]
    good, bad = q.split_by_checks(rows, checks)
    assert good.count() + bad.count() == rows.count()
    assert q.check_report(good, checks).filter("failures > 0").isEmpty()
    assert good.columns == rows.columns


def test_max_length(spark):
    rows = spark.createDataFrame([("ab",), ("abc",), (None,)], "v string")
    report = q.check_report(rows, [q.max_length("v", 2)])
    assert report.first().failures == 1


def test_unknown_kind():
    with pytest.raises(ValueError):
        q.Check("other", "x").violation()




def test_constraints_at_load_act_as_inserting_row_by_row(spark):
    """Two unique keys: a row that was refused holds none of its keys."""
    rng = random.Random(3)
    rows = []
    for i in range(400):
        key = rng.choice([None, *range(90)])
        other = rng.choice([None, *(f"i{n}" for n in range(120))])
        rows.append((i // 2, key, other, rng.choice(["a", "b", "bad", None])))
    rows += [(7, 500, "same", "a")] * 3
    checks = [q.unique("key"), q.unique("other"), q.not_null("key"), q.accepted("kind", ["a", "b"]), q.row_count(low=1)]
    df = spark.createDataFrame(rows, "time int, key int, other string, kind string").coalesce(1)
    good, bad = q.split_at_load(df, checks, ["time"])
    keys, others, loaded, refused = set(), set(), [], []
    for row in sorted(rows, key=lambda r: r[0]):  # stable: equal times in the given order
        why = ["not_null(key)"] * (row[1] is None) + ["accepted(kind)"] * (row[3] == "bad")
        if why:
            refused.append((*row, "; ".join(why)))
        elif row[1] in keys or row[2] is not None and row[2] in others:
            refused.append((*row, None))
        else:
            loaded.append(row)
            keys.add(row[1])
            others.add(row[2])
    for i, row in enumerate(refused):
        if row[4] is None:
            why = ["unique(key)"] * (row[1] in keys) + ["unique(other)"] * (row[2] is not None and row[2] in others)
            refused[i] = (*row[:4], "; ".join(why))
    assert Counter(map(tuple, good.collect())) == Counter(loaded)
    assert Counter(map(tuple, bad.collect())) == Counter(refused)
    assert good.columns == df.columns and bad.columns == [*df.columns, "reason"]


def test_constraints_at_load_without_rows_or_keys(spark):
    empty = spark.createDataFrame([], "time int, key int")
    assert [part.count() for part in q.split_at_load(empty, [q.unique("key")], ["time"])] == [0, 0]
    rows = spark.createDataFrame([(1, None), (1, None), (2, 5)], "time int, key int")
    assert [part.count() for part in q.split_at_load(rows, [q.unique("key")], ["time"])] == [3, 0]
    assert [part.count() for part in q.split_at_load(rows, [q.not_null("key")], ["time"])] == [1, 2]
