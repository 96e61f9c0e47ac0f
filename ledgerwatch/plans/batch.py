"""One batch run: bronze loads, staging, reconciliation, marts, checks and history."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.operators.marts import aml_alerts, fct_transactions
from ledgerwatch.operators.quality import Check, run_checks, split_at_load
from ledgerwatch.operators.reconcile import reconcile_raw
from ledgerwatch.operators.snapshots import (
    CUSTOMER_CHECKS,
    CUSTOMER_KEY,
    empty_history,
    scd2_apply,
    snapshot_source,
)
from ledgerwatch.operators.staging import stage_customers, stage_payments
from ledgerwatch.operators.upserts import apply_block_decisions
from ledgerwatch.plans import declared
from ledgerwatch.schemas import CrossBorderRule
from ledgerwatch.sources.bronze import extract_to_bronze, settlements_to_bronze
from ledgerwatch.sources.lake import Lake
from ledgerwatch.workspace import staged

T = TypeVar("T")
RECONCILED = "reconciled_transactions"
OPEN_VERSIONS = "snap_customers_open"
CLOSED_VERSIONS = "snap_customers_closed"
#: Layer of the rows that the constraints of the source tables refuse.
QUARANTINE = "quarantine"


@dataclass(frozen=True)
class Sources:
    """Where a run reads from.

    ``decisions`` are the stream's blocks, as the velocity job writes them; they are
    laid over the transactions before these are loaded.
    """

    customers: DataFrame
    transactions: DataFrame
    settlement_folder: str
    settlement_mode: str = "merge_latest"
    decisions: DataFrame | None = None


def staging_views(lake: Lake, key: str) -> dict[str, DataFrame]:
    """The silver staging layer over the newest bronze tables; nothing is written."""
    return {
        "stg_transactions": stage_payments(lake.read("bronze", "raw_transactions"), key),
        "stg_settlements": stage_payments(lake.read("bronze", "raw_settlements"), key, "loaded_at"),
        "stg_customers": stage_customers(lake.read("bronze", "raw_customers"), key),
    }


def register_views(views: dict[str, DataFrame]) -> None:
    """Make the staging layer available to SQL."""
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def update_customer_history(lake: Lake, raw_customers: DataFrame, key: str, run_ts: datetime) -> None:
    """Advance the customer history by one run.

    Only the open versions are rewritten, one per customer. Versions that this run
    closes are added to the closed ones, which no later run reads or writes. The open
    versions are written last and are the mark of the run: closed ones of a run without
    them are not read, and a repeated run replaces both parts, also where it closes none.
    """
    source = snapshot_source(raw_customers, key)
    before = lake.read("gold", OPEN_VERSIONS, before=run_ts)
    if before is None:
        before = empty_history(source)
    after = scd2_apply(before, source, CUSTOMER_KEY, CUSTOMER_CHECKS, run_ts)
    with staged(after, "history") as (versions, _):
        lake.write(versions.filter(F.col("valid_to").isNotNull()), "gold", CLOSED_VERSIONS, run_ts)
        lake.write(versions.filter(F.col("valid_to").isNull()), "gold", OPEN_VERSIONS, run_ts)


def customer_history(lake: Lake) -> DataFrame | None:
    """All versions of all customers."""
    runs = lake.runs("gold", OPEN_VERSIONS)
    if not runs:
        return None
    live = lake.read("gold", OPEN_VERSIONS)
    closed = lake.read_all("gold", CLOSED_VERSIONS, upto=runs[-1])
    return live if closed is None else live.unionByName(closed)


def _together(*steps: Callable[[], T]) -> list[T]:
    """Run steps that do not need each other at the same time; the first error is raised.

    Spark shares the executors among their jobs, so the last tasks of one step do
    not leave the cluster idle.
    """
    with ThreadPoolExecutor(len(steps)) as pool:
        return [future.result() for future in [pool.submit(step) for step in steps]]


def load_and_stage(
    lake: Lake, sources: Sources, key: str, run_ts: datetime, check: bool, constrain: bool
) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, DataFrame]]:
    """Load bronze and check the staged views: settlements, customers, transactions and the views."""
    live = sources.transactions
    if sources.decisions is not None:
        live = apply_block_decisions(live, sources.decisions)
    customers = sources.customers
    if constrain:

        def constrained(rows: DataFrame, name: str, checks: list[Check], time: str) -> DataFrame:
            good, bad = split_at_load(rows, checks, [time])
            lake.write(bad, QUARANTINE, name, run_ts)
            return good

        customers, live = _together(
            lambda: constrained(customers, "raw_customers", declared.SOURCE_CUSTOMERS, "created_at"),
            lambda: constrained(live, "raw_transactions", declared.SOURCE_TRANSACTIONS, "executed_at"),
        )
    given_customers, given_transactions = customers, live
    settlements, customers, transactions = _together(
        lambda: settlements_to_bronze(
            lake, sources.settlement_folder, run_ts, sources.settlement_mode
        ),
        lambda: extract_to_bronze(given_customers, lake, "raw_customers", run_ts),
        lambda: extract_to_bronze(given_transactions, lake, "raw_transactions", run_ts),
    )
    views = staging_views(lake, key)
    register_views(views)

    if check:
        # Checked first: the joins of the marts rely on unique transaction ids.
        _together(
            lambda: run_checks(views["stg_transactions"], declared.STG_TRANSACTIONS, "stg_transactions"),
            lambda: run_checks(views["stg_customers"], declared.STG_CUSTOMERS, "stg_customers"),
        )
    return settlements, customers, transactions, views


def run_batch(
    lake: Lake,
    sources: Sources,
    key: str,
    run_ts: datetime,
    rule: CrossBorderRule = CrossBorderRule(),
    check: bool = True,
    versions: int | None = None,
    constrain: bool = False,
) -> dict[str, DataFrame]:
    """Run the whole pipeline into ``lake`` and return its gold tables.

    ``versions`` is the number of newest bronze and silver versions that are kept once
    the run is through, None for all. Gold tables and the history are never pruned.

    With ``constrain``, customers and transactions pass the constraints of their source tables
    first, as when inserted row by row by time; what these refuse goes to the layer
    ``quarantine`` with the reason, and the run goes on with the others.

    A check that fails raises and stops the run before the next layer. Running the
    same ``run_ts`` again gives the same tables, and unchanged customers add no
    versions.
    """
    if versions is not None and versions < 1:
        raise ValueError("at least one version is kept")
    settlements, customers, transactions, views = load_and_stage(lake, sources, key, run_ts, check, constrain)

    def checked(table: DataFrame, name: str, checks: list[Check]) -> DataFrame:
        if check:
            run_checks(table, checks, name)
        return table

    # Both marts read the reconciled rows, so they are joined once and written.
    reconciled = lake.write(
        reconcile_raw(transactions, settlements, key), "silver", RECONCILED, run_ts
    )

    def write_facts() -> DataFrame:
        rows = fct_transactions(reconciled, views["stg_customers"])
        table = lake.write(rows, "gold", "fct_transactions", run_ts)
        return checked(table, "fct_transactions", declared.FCT_TRANSACTIONS)

    def write_alerts() -> DataFrame:
        rows = aml_alerts(reconciled, views["stg_customers"], run_ts, rule)
        table = lake.write(rows, "gold", "fct_daily_aml_alerts", run_ts)
        return checked(table, "fct_daily_aml_alerts", declared.AML_ALERTS)

    facts, alerts, _ = _together(
        write_facts,
        write_alerts,
        lambda: update_customer_history(lake, customers, key, run_ts),
    )
    if versions is not None:
        for name in ("raw_customers", "raw_transactions", "raw_settlements"):
            lake.keep_newest("bronze", name, versions)
        lake.keep_newest("silver", RECONCILED, versions)
    return {
        "fct_transactions": facts,
        "fct_daily_aml_alerts": alerts,
        "snap_customers": customer_history(lake),
    }
