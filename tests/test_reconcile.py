from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from ledgerwatch.operators.marts import fct_transactions
from ledgerwatch.operators.reconcile import reconcile, reconcile_raw
from ledgerwatch.operators.staging import PII_COLUMNS, stage_customers, stage_payments
from ledgerwatch.schemas import CUSTOMER_COLUMNS, TRANSACTION_COLUMNS

KEY = "k"
AT = datetime(2024, 1, 2, 3, 4, 5, 6)
RAW = "transaction_id string, sender_iban string, beneficiary_iban string, amount string, currency string, payment_channel string, status string, blocked_reason string, executed_at timestamp_ntz, {} timestamp_ntz"


def row(tid, amount, status, reason=None, to="DE0012345678"):
    return (tid, "FR0012345678", to, amount, "EUR", "SEPA", status, reason, AT, AT)


@pytest.fixture
def sides(spark):
    live = [
        row("both", "10,00", "PENDING"),
        row("live-only", "20,00", "PENDING"),
        row("blocked", "30,00", "BLOCKED", "why"),
        row("blocked-settled", "40,00", "BLOCKED", "why"),
        row("early-settled", "50,00", "SETTLED"),
    ]
    settled = [
        row("both", "1.010,00", "SETTLED"),
        row("blocked-settled", "41,00", "SETTLED"),
        row("settled-only", "60,00", "SETTLED", to="FR00"),
    ]
    return (
        spark.createDataFrame(live, RAW.format("ingested_at")),
        spark.createDataFrame(settled, RAW.format("loaded_at")),
    )


def test_status_and_amount_precedence(sides):
    live, settled = sides
    both_ways = [
        reconcile(stage_payments(live, KEY), stage_payments(settled, KEY, "loaded_at")),
        reconcile_raw(live, settled, KEY),
    ]
    for result in both_ways:
        assert len(result.columns) == 14
        found = {
            r.transaction_id: (
                r.final_status,
                r.amount_eur,
                r.blocked_reason,
                r.seen_in_stream,
                r.seen_in_settlement,
                r.is_cross_border,
            )
            for r in result.collect()
        }
        assert found == {
            "both": ("SETTLED", Decimal("1010.00"), None, True, True, True),
            "live-only": ("PENDING", Decimal("20.00"), None, True, False, True),
            "blocked": ("BLOCKED", Decimal("30.00"), "why", True, False, True),
            "blocked-settled": ("BLOCKED", Decimal("41.00"), "why", True, True, True),
            "early-settled": ("SETTLED", Decimal("50.00"), None, True, False, True),
            "settled-only": ("SETTLED", Decimal("60.00"), None, False, True, False),
        }
    assert both_ways[0].exceptAll(both_ways[1]).isEmpty()


def test_masking_after_the_join_shuffles_no_hashes(sides):
    live, settled = sides
    plan = reconcile_raw(live, settled, KEY)._jdf.queryExecution().executedPlan().toString()
    join = plan.index("FullOuter")
    assert "sha2" in plan[:join]
    assert "sha2" not in plan[join:]


def test_facts_keep_unknown_senders(spark, sides):
    live, settled = sides
    reconciled = reconcile_raw(live, settled, KEY)
    customer = ("C1", "a", "b", "e", "p", "FR0012345678", "x", "y", "FR", "PEP", AT, AT)
    schema = ", ".join(f"{c} string" for c in CUSTOMER_COLUMNS[:-1])
    customers = spark.createDataFrame([customer], f"{schema}, created_at timestamp_ntz, ingested_at timestamp_ntz")
    facts = fct_transactions(reconciled, stage_customers(customers, KEY))
    assert len(facts.columns) == 16
    assert {(r.customer_id, r.risk_tier) for r in facts.collect()} == {("C1", "PEP")}
    nobody = fct_transactions(reconciled, stage_customers(customers, "other key"))
    assert nobody.count() == 6
    assert {r.customer_id for r in nobody.collect()} == {None}


def test_pii_can_be_dropped(spark):
    schema = ", ".join(f"{c} string" for c in CUSTOMER_COLUMNS[:-1])
    empty = spark.createDataFrame([], f"{schema}, created_at timestamp_ntz, ingested_at timestamp_ntz")
    assert set(stage_customers(empty, KEY).columns) >= set(PII_COLUMNS)
    assert not set(stage_customers(empty, KEY, drop_pii=True).columns) & set(PII_COLUMNS)
    assert "iban" not in stage_customers(empty, KEY).columns


def test_staging_drops_raw_ibans(sides):
    columns = stage_payments(sides[0], KEY).columns
    assert len(columns) == 13
    assert not {"sender_iban", "beneficiary_iban", "amount"} & set(columns)
    assert set(TRANSACTION_COLUMNS) & set(columns)


def test_bad_amounts_of_either_side(spark):
    live = [row("a", "12,50", "PENDING"), row("b", "abc", "PENDING"), row("c", "abc", "PENDING")]
    settled = [row("a", "abc", "SETTLED"), row("b", "7,00", "SETTLED")]
    live = spark.createDataFrame(live, RAW.format("ingested_at"))
    settled = spark.createDataFrame(settled, RAW.format("loaded_at"))

    def both_ways(live, settled, strict):
        staged = stage_payments(live, KEY, strict=strict), stage_payments(settled, KEY, "loaded_at", strict=strict)
        return [reconcile(*staged), reconcile_raw(live, settled, KEY, strict)]

    for result in both_ways(live, settled, False):
        found = {r.transaction_id: r.amount_eur for r in result.collect()}
        assert found == {"a": Decimal("12.50"), "b": Decimal("7.00"), "c": None}
    for result in both_ways(live.filter("transaction_id = 'b'"), settled.filter("transaction_id = 'b'"), True):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            result.collect()
