"""Compare checked queries with their SQL oracles.

``python -m testbed.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def open_oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def difference(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both give the same columns and rows, else what differs."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} but expected {sorted(names)}"
    want = _bag(names, expected.fetchall())
    have = _bag(result.columns, result.collect())
    if want == have:
        return ""
    more, less = have - want, want - have
    return (
        f"{have.total()} rows, expected {want.total()}; "
        f"extra {more.total()} e.g. {next(iter(more), None)}; "
        f"missing {less.total()} e.g. {next(iter(less), None)}"
    )


def main(arguments: list[str]) -> int:
    from testbed.oracle import ORACLES
    from testbed.queries import QUERIES

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    names = arguments[1:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = open_oracle(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            found = difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name])
        except Exception as error:  # report and go on with the next query
            found = f"{type(error).__name__}: {error}"[:1500]
        failed += bool(found)
        print(f"{name}: {found or 'ok'} ({time.time() - start:.2f} s)", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return min(failed, 1)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
