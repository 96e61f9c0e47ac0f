"""A batch run that recomputes only what has changed since the last one.

Bronze is loaded as in a full run. Then

1. the old and the new version of each bronze table are compared by digests per day, which needs no
   shuffle of rows, and within the days that differ by row digests. This gives the ids of changed payments;
2. these payments are reconciled anew, and the months that hold them are rewritten;
3. facts are rewritten for these months, and for months with payments of customers that have changed;
4. a changed cross-border payment acts on its sender's alerts from its own time until the window has
   passed. The alerts of such senders are computed anew for the months of that time, from these months and
   those before that the window reaches; other rows of these months are taken over.

The tables are those of a full run, but for ``detected_at``: an alert keeps the time of the run that
computed it last. Without an earlier run, with another key or rule, or where the bronze versions of the
earlier run are gone, everything is computed.
"""

from __future__ import annotations

from datetime import datetime
from hashlib import sha256

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.functions.columns import packed_hashes, unpacked_hashes
from ledgerwatch.operators.marts import alert_candidates, aml_alerts, fct_transactions
from ledgerwatch.operators.quality import run_checks
from ledgerwatch.operators.reconcile import reconcile_raw
from ledgerwatch.operators.staging import masked_iban
from ledgerwatch.plans import declared
from ledgerwatch.plans.batch import Sources, customer_history, load_and_stage, update_customer_history
from ledgerwatch.schemas import TRANSACTION_COLUMNS, CrossBorderRule
from ledgerwatch.sources import months as M
from ledgerwatch.sources.lake import Lake, run_id
from ledgerwatch.workspace import stage, stage_counted

STATE = "marts_by_month"
RECONCILED = "reconciled_by_month"
FACTS = "fct_transactions_by_month"
ALERTS = "fct_daily_aml_alerts_by_month"
#: In the state, the bronze versions and settings that the months were made from.
MADE_FROM = "_made_from"
BRONZE = ("raw_transactions", "raw_settlements", "raw_customers")


def _digests(columns: tuple[str, ...] | list[str]) -> list[Column]:
    """128 bits of a row; NULLs count by their place."""
    parts = [*map(F.col, columns), *(F.col(c).isNull() for c in columns)]
    return [F.xxhash64(F.lit(seed), *parts).alias(f"_h{seed}") for seed in (1, 2)]


def _days_that_differ(old: DataFrame, new: DataFrame, columns: list[str], at: str) -> DataFrame:
    """``day`` of the days whose rows are not the same in both; a row per day is shuffled for each task."""

    def per_day(rows: DataFrame, side: int) -> DataFrame:
        return rows.select(F.col(at).cast("date").alias("day"), F.lit(side).alias("_side"), *_digests(columns))

    # Equal rows of both sides cancel each other in every sum.
    weigh = lambda c: F.sum(F.col(c).cast("decimal(20,0)") * F.col("_side"))
    sums = per_day(old, -1).unionByName(per_day(new, 1)).groupBy("day").agg(
        F.sum("_side").alias("n"), weigh("_h1").alias("a"), weigh("_h2").alias("b")
    )
    return sums.where("n <> 0 or a <> 0 or b <> 0").select("day")


def differing(old: DataFrame, new: DataFrame, columns: list[str], keep: list[str], at: str | None = None) -> DataFrame:
    """Distinct ``keep`` values of rows that one side holds more often than the other.

    With a time column ``at`` only rows of days that differ are compared one by one.
    """
    if at is not None:
        days = _days_that_differ(old, new, columns, at)
        old, new = (t.join(days, t[at].cast("date").eqNullSafe(days["day"]), "left_semi") for t in (old, new))
    sides = [t.select(*keep, F.lit(side).alias("_side"), *_digests(columns)) for t, side in ((old, -1), (new, 1))]
    counts = sides[0].unionByName(sides[1]).groupBy(*keep, "_h1", "_h2").agg(F.sum("_side").alias("_n"))
    return counts.where("_n <> 0").select(*keep).distinct()


def _only(rows: DataFrame, column: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose column is (or with ``left_anti``: is not) among the keys, NULL included."""
    rows, keys = packed_hashes(rows), packed_hashes(keys)
    return unpacked_hashes(rows.join(keys, rows[column].eqNullSafe(keys[keys.columns[0]]), how))


def _months_before(months: set[str], days: int) -> set[str]:
    """The months, and those before them that a window of ``days`` reaches."""
    out = set()
    for month in months - {M.NO_MONTH}:
        year, number = (int(part) for part in month.rsplit("-", 1))
        for back in range(days // 28 + 2):
            y, m = divmod(12 * year + number - 1 - back, 12)
            out.add(f"{y:04d}-{m + 1:02d}" if y <= 9999 else f"+{y}-{m + 1:02d}")
    return out


def _months_acted_on(changed: DataFrame, days: int) -> set[str]:
    """Months in which a total may have changed: from a payment's own until the window has passed."""
    first, last = F.trunc("executed_at", "month"), F.trunc(F.col("executed_at") + F.make_interval(days=F.lit(days)), "month")
    starts = changed.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias("at"))
    return M.months_in(starts, "at")


def run_incremental(
    lake: Lake,
    sources: Sources,
    key: str,
    run_ts: datetime,
    rule: CrossBorderRule = CrossBorderRule(),
    check: bool = True,
    versions: int | None = None,
    constrain: bool = False,
) -> dict[str, DataFrame]:
    """Run the whole pipeline like ``run_batch``, but rewrite only months with changes.

    Arguments are those of ``run_batch``; ``versions`` also prunes months that only older runs
    name. A check of the staged rows covers all of them, one of the marts the months that are written.
    Payments without a time are a month of their own, and payments without id are
    reconciled anew together if any of them changes. An empty difference rewrites nothing. The
    marts of the earlier run stay in force until all of this run's are through.
    """
    if versions is not None and versions < 1:
        raise ValueError("at least one version is kept")
    settlements, customers, transactions, views = load_and_stage(lake, sources, key, run_ts, check, constrain)
    owners = views["stg_customers"]
    made = {name: lake.runs("bronze", name)[-1] for name in BRONZE}
    made["settings"] = sha256(f"{key}|{rule}".encode()).hexdigest()
    before = M.read_state(lake, STATE, before=run_ts)
    shape = reconcile_raw(transactions, settlements, key).schema
    every = {t: dict((before or {}).get(t, {})) for t in (RECONCILED, FACTS, ALERTS)}

    def rewrite(table: str, rows: DataFrame, months: set[str] | None) -> None:
        """Write the rows as these months (all, if None) of a table; months that are left without rows go."""
        if months is not None and not months:
            return
        written = M.write_months(lake, rows, table, run_ts)
        kept = {} if months is None else {m: r for m, r in every[table].items() if m not in months}
        every[table] = kept | written

    def reconciled(months: set[str] | None = None) -> DataFrame:
        return M.read_months(lake, RECONCILED, shape, every[RECONCILED], months)

    alerts_shape = aml_alerts(lake.spark.createDataFrame([], shape), owners, run_ts, rule).schema
    if _usable(lake, before, made):
        past = {name: lake.spark.read.parquet(f"{lake.folder('bronze', name)}/run={before[MADE_FROM][name]}") for name in BRONZE}
        ids, senders, n_senders = _changes(past, transactions, settlements, customers, key)
        fresh = stage(reconcile_raw(_only(transactions, "transaction_id", ids), _only(settlements, "transaction_id", ids), key), "reconciled")
        # Of the rows that go only what tells the months and senders that they act on.
        acting_in = ["transaction_id", "sender_iban_hmac", "executed_at", "is_cross_border", "final_status"]
        acts = F.col("is_cross_border") & (F.col("final_status") != "BLOCKED")
        before_now = reconciled().withColumn("sender_iban_hmac", F.when(acts, F.col("sender_iban_hmac"))).select(*acting_in)
        gone = stage(_only(before_now, "transaction_id", ids), "reconciled")
        changed = gone.unionByName(fresh.select(*acting_in))
        months = M.months_in(changed)
        rewrite(RECONCILED, _only(reconciled(months), "transaction_id", ids, "left_anti").unionByName(fresh), months)
        owned = M.months_in(_only(reconciled(), "sender_iban_hmac", senders)) if n_senders else set()
        fact_months = months | owned
        rewrite(FACTS, fct_transactions(reconciled(fact_months), owners), fact_months)
        acting = alert_candidates(changed, ("sender_iban_hmac", "executed_at"))
        alert_months = _months_acted_on(acting, rule.days) | owned
        touched = stage(acting.select("sender_iban_hmac").unionByName(senders).distinct(), "senders")
        wanted = M.month_of("executed_at").isin(sorted(alert_months))
        reached = _only(reconciled(_months_before(alert_months, rule.days)), "sender_iban_hmac", touched)
        old = M.read_months(lake, ALERTS, alerts_shape, every[ALERTS], alert_months)
        if alert_months:
            again = aml_alerts(reached, owners, run_ts, rule).where(wanted)
            rewrite(ALERTS, _only(old, "sender_iban_hmac", touched, "left_anti").unionByName(again), alert_months)
    else:
        rewrite(RECONCILED, reconcile_raw(transactions, settlements, key), None)
        rewrite(FACTS, fct_transactions(reconciled(), owners), None)
        rewrite(ALERTS, aml_alerts(reconciled(), owners, run_ts, rule), None)
    facts_shape = fct_transactions(reconciled(), owners).schema
    shapes = {FACTS: (facts_shape, declared.FCT_TRANSACTIONS), ALERTS: (alerts_shape, declared.AML_ALERTS)}
    if check:
        for table, (schema, checks) in shapes.items():
            mine = [m for m, run in every[table].items() if run == run_id(run_ts)]
            if mine:
                run_checks(M.read_months(lake, table, schema, every[table], mine), checks, table)
    update_customer_history(lake, customers, key, run_ts)
    M.write_state(lake, STATE, every | {MADE_FROM: made}, run_ts)
    if versions is not None:
        for name in BRONZE:
            lake.keep_newest("bronze", name, versions)
        M.prune_months(lake, STATE, versions)
    return {
        "fct_transactions": M.read_months(lake, FACTS, facts_shape, every[FACTS]),
        "fct_daily_aml_alerts": M.read_months(lake, ALERTS, alerts_shape, every[ALERTS]),
        "snap_customers": customer_history(lake),
    }


def _usable(lake: Lake, before: M.State | None, made: dict[str, str]) -> bool:
    """Whether the earlier run had the same settings, and its bronze versions are there to compare with."""
    if before is None or before[MADE_FROM]["settings"] != made["settings"]:
        return False
    return all(before[MADE_FROM][name] in lake.runs("bronze", name) for name in BRONZE)


def _changes(past: dict[str, DataFrame], transactions: DataFrame, settlements: DataFrame, customers: DataFrame, key: str) -> tuple[DataFrame, DataFrame, int]:
    """Ids of payments that differ, senders whose customer differs, and the number of these."""
    columns, at = list(TRANSACTION_COLUMNS), "executed_at"
    ids = differing(past["raw_transactions"], transactions, columns, ["transaction_id"], at)
    ids = ids.unionByName(differing(past["raw_settlements"], settlements, columns, ["transaction_id"], at)).distinct()
    owner = ["iban", "customer_id", "risk_tier"]
    ibans = differing(past["raw_customers"], customers, owner, ["iban"]).where("iban is not null")
    senders, n = stage_counted(ibans.select(*masked_iban("iban", key)).select(F.col("iban_hmac").alias("sender_iban_hmac")), "senders")
    return stage(ids, "changed-ids"), senders, n
