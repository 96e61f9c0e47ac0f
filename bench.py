"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local cores. Each
query runs to a sink that discards rows, once to warm up and then ``BENCH_RUNS``
times; the best time counts, from the call that builds the plan to the last row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.operators.marts import aml_alerts
from ledgerwatch.workspace import stage
from testbed import bank, queries

HEADLINES = [
    "reconcile",
    "reconcile_from_bronze",
    "fct_transactions",
    "rolling_30d",
    "aml_alerts",
    "velocity_batch",
    "velocity_batch_sliced",
    "velocity_stream",
    "src_settlements_merge_latest",
    "insert_absent_txns",
    "validate_records",
    "scd2_history",
    "as_of_lookup",
    "dq_gate",
    "kpi_fraud_breakdown",
    "live_feed",
    "batch_run",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def best_time(run, runs: int) -> float:
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(min(times[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerwatch-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")

    times = {}
    for name in HEADLINES:
        times[name] = best_time(lambda: drain(queries.QUERIES[name](spark, sf_dir)), runs)

    # The alert mart as a run computes it, from the reconciled table.
    reconciled = stage(queries.reconciled(spark, sf_dir), "bench")
    customers = stage(queries.stg_cust(spark, sf_dir), "bench")
    times["aml_alerts_from_table"] = best_time(
        lambda: drain(aml_alerts(reconciled, customers, bank.RUN_TS)), runs
    )
    spark.stop()
    line = {
        "metric": "headline queries, sum of best times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
