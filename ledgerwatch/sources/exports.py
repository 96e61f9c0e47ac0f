"""File exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.schemas import CUSTOMER_COLUMNS, CUSTOMERS, TRANSACTION_COLUMNS


# Doubled quotes, as spreadsheet programs and other CSV readers expect.
CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "escape": '"',
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def export_customers_csv(customers: DataFrame, path: str) -> None:
    """UTF-8 CSV with a header. One file per partition, never gathered in one task."""
    customers.select(*CUSTOMER_COLUMNS).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_customers_csv(spark: SparkSession, path: str) -> DataFrame:
    """Customers as :func:`export_customers_csv` writes them."""
    return spark.read.schema(CUSTOMERS).options(**CSV_OPTIONS).csv(path)


def export_settlements(settlements: DataFrame, folder: str) -> None:
    """Settlement files as ``file_date=<date>`` partitions.

    Exporting a date again replaces that date and leaves the others. The rows of a
    date are brought together, and the rebalance splits a day that is too large for
    one task into several files.
    """
    rows = settlements.select(*TRANSACTION_COLUMNS, "file_date").hint("rebalance", "file_date")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "file_date"
    ).parquet(folder)
