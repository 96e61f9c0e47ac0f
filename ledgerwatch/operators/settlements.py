"""Selection of the payments that a settlement file confirms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.schemas import TRANSACTION_COLUMNS

# A file confirms payments made this many days before its date.
NEWEST_DAYS_BACK = 1
OLDEST_DAYS_BACK = 3


def settlement_eligible(transactions: DataFrame, file_date: date | Column) -> DataFrame:
    """Pending payments of the three days before ``file_date``.

    Written as a range on ``executed_at`` itself, which a scan can push down.
    """
    day = file_date if isinstance(file_date, Column) else F.lit(file_date)
    start = F.date_sub(day, OLDEST_DAYS_BACK).cast("timestamp_ntz")
    end = F.date_sub(day, NEWEST_DAYS_BACK - 1).cast("timestamp_ntz")
    at = F.col("executed_at")
    chosen = transactions.filter((F.col("status") == "PENDING") & (at >= start) & (at < end))
    return chosen.select(*TRANSACTION_COLUMNS)
