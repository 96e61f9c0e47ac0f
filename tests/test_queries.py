from __future__ import annotations

import pytest

import __spark_entry__ as contract
from testbed.compare import difference, open_oracle
from testbed.oracle import ORACLES
from testbed.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_agrees_with_the_oracle(spark, oracle, name):
    result = contract.queries()[name](spark, SMALL)
    assert difference(result, oracle, contract.oracle_sql()[name]) == ""
    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in SLOW_OPERATORS:
        assert operator not in plan


# Pair-wise joins, and rows that leave the JVM.
SLOW_OPERATORS = ["CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


# Row counts measured apart from this code, with prototype SQL.
@pytest.mark.parametrize(
    "name, rows", [("risk_lookup", 138), ("src_bronze_extract", 990), ("stg_settlements", 750),
                   ("reconcile", 997), ("aml_alerts", 179), ("velocity_batch", 9)]
)
def test_expected_row_counts(spark, name, rows):
    assert contract.queries()[name](spark, SMALL).count() == rows


def test_entry(spark):
    assert contract.entry(spark).count() == 179
