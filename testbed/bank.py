"""Bank input tables, derived row by row from ``customer``, ``nation`` and ``events``.

``testbed/oracle.py`` states the same derivations in SQL. All of them are plain
column expressions, so the bank grows with the given tables.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.functions.columns import from_micros, micros, timestamp_ntz
from ledgerwatch.schemas import TRANSACTION_COLUMNS

KEY = "k-test"
RUN_TS = datetime(2024, 4, 1, 6, 30)
START = datetime(2024, 1, 1)

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
NATION = "n_nationkey int, n_name string, n_regionkey int"


def padded(value: Column, width: int) -> Column:
    return F.lpad(value.cast("string"), width, "0")


def iban_of(number: Column) -> Column:
    return F.concat(F.lit("FR"), padded(number % 97, 2), padded(number, 23))


def european_text(cents: Column) -> Column:
    """Amount text with thousands dots, such as ``1.234,56``."""
    whole = F.translate(F.format_number(F.floor(cents / 100), 0), ",", ".")
    return F.concat(whole, F.lit(","), padded(cents % 100, 2))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet")
    number = F.col("c_custkey")
    text = number.cast("string")
    share = (number * 37) % 100
    return (
        customer.filter(number % 13 != 5)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("C"), padded(number, 9)).alias("customer_id"),
            F.col("c_name").alias("first_name"),
            F.concat(F.lit("L"), text).alias("last_name"),
            F.concat(F.lit("c"), text, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("+33"), padded(number, 9)).alias("phone_number"),
            iban_of(number).alias("iban"),
            F.concat(text, F.lit(" rue "), "c_mktsegment").alias("address"),
            F.col("n_name").alias("city"),
            F.lit("FR").alias("country"),
            F.when(share < 70, "LOW")
            .when(share < 90, "MEDIUM")
            .when(share < 97, "HIGH")
            .otherwise("PEP")
            .alias("risk_tier"),
            (
                F.lit("2022-01-01").cast("timestamp_ntz")
                + F.make_dt_interval(hours=number.cast("int"))
            ).alias("created_at"),
        )
    )


def payments(events: DataFrame, spread: Column | None = None) -> DataFrame:
    """One payment per event, with the helper columns ``event_id`` and ``cents``."""
    number = F.col("event_id")
    country = (
        F.when(number % 10 >= 3, "FR")
        .when(number % 3 == 0, "DE")
        .when(number % 3 == 1, "ES")
        .otherwise("IT")
    )
    start = timestamp_ntz(START)
    at = spread if spread is not None else start + (F.col("ts") - start) * 3
    return events.select(
        number,
        F.concat(F.lit("T"), padded(number, 10)).alias("transaction_id"),
        iban_of(F.col("user_id")).alias("sender_iban"),
        F.concat(country, padded(number % 89, 2), padded(number, 18)).alias("beneficiary_iban"),
        F.round(F.col("value") * 4000).cast("bigint").alias("cents"),
        F.when(F.col("event_type") == "purchase", "INSTANT_SEPA")
        .when(F.col("event_type").isin("click", "view"), "CARD")
        .otherwise("SEPA")
        .alias("payment_channel"),
        at.alias("executed_at"),
    )


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def as_transactions(rows: DataFrame) -> DataFrame:
    """Live payments; helper columns are kept."""
    manual = F.col("event_id") % 47 == 0
    return rows.withColumns(
        {
            "amount": european_text(F.col("cents")),
            "currency": F.lit("EUR"),
            "status": F.when(manual, "BLOCKED").otherwise("PENDING"),
            "blocked_reason": F.when(manual, "MANUAL"),
        }
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ev(spark, sf_dir).filter(F.col("event_id") % 101 != 0)
    return as_transactions(rows).select(*TRANSACTION_COLUMNS)


def raw_settlements(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("event_id")
    corrected = F.when(number % 20 == 1, F.col("cents") + 50 + number % 451).otherwise(
        F.col("cents")
    )
    rows = ev(spark, sf_dir).filter(number % 4 != 0)
    return as_transactions(rows.withColumn("cents", corrected)).select(
        *(
            F.lit("SETTLED").alias(name)
            if name == "status"
            else F.lit(None).cast("string").alias(name)
            if name == "blocked_reason"
            else name
            for name in TRANSACTION_COLUMNS
        )
    )


def compressed(ts: Column) -> Column:
    """Thirty days of events squeezed into three hours, to microseconds."""
    start = micros(timestamp_ntz(START))
    passed = F.floor((micros(ts) - start) / 240)
    return from_micros(start + passed)


def velocity_feed(events: DataFrame) -> DataFrame:
    """Payments dense enough for the velocity rule; works on a stream as well."""
    rows = payments(events, compressed(F.col("ts")))
    return as_transactions(rows).withColumnRenamed("event_id", "arrival").drop("cents")


def velocity_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return velocity_feed(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def one_second(rows: DataFrame, sender: str, candidates: DataFrame) -> DataFrame:
    """All rows of the sender with most candidates put on one time stamp."""
    largest = candidates.groupBy(F.col(sender).alias("busiest")).count().orderBy(F.desc("count"), "busiest").limit(1)
    together = F.col("busiest").isNotNull()
    joined = rows.join(largest.drop("count"), F.col(sender) == F.col("busiest"), "left")
    return joined.withColumn("executed_at", F.when(together, timestamp_ntz(START)).otherwise(F.col("executed_at"))).drop("busiest")


#: Micro-batches that the event table is fed in, and the microseconds of arrival that each covers.
SLICES, SLICE_MICROS = 6, 2_200_000_000


def unordered_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it arrives: a fifth of the payments up to 40 minutes late. With its ``slice``."""
    number = F.col("arrival")
    behind = F.when(number % 5 == 0, (number * 7919) % 40).otherwise(0) * 60_000_000
    since = micros(F.col("executed_at")) - micros(timestamp_ntz(START)) + behind
    feed = velocity_payments(spark, sf_dir).withColumn("since", since)
    part = F.least(F.floor(F.col("since") / SLICE_MICROS), F.lit(SLICES - 1)).cast("int")
    return feed.withColumns({"arrival": F.col("since") * 1_000_000 + number % 1_000_000, "slice": part}).drop("since")


def redelivered_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed in order, half of it delivered again: one micro-batch later, or with the last one."""
    feed = velocity_payments(spark, sf_dir)
    since = micros(F.col("executed_at")) - micros(timestamp_ntz(START))
    first = F.least(F.floor(since / 1_800_000_000), F.lit(SLICES - 1)).cast("int")
    last = F.lit(SLICES - 1)
    again = F.when(F.col("arrival") % 4 == 1, F.least(first + 1, last)).when(F.col("arrival") % 4 == 2, last)
    return feed.withColumn("slice", F.explode(F.array_compact(F.array(first, again))))


def audited(df: DataFrame, column: str = "ingested_at") -> DataFrame:
    return df.withColumn(column, timestamp_ntz(RUN_TS))




def settlement_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of daily settlement files: a payment shows up one to three days later,
    in most of the three files, and with another amount each time for some."""
    pending = ev(spark, sf_dir).filter(F.col("event_id") % 47 != 0)
    copies = pending.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).filter(
        (F.col("event_id") + F.col("k")) % 4 != 0
    )
    shifted = F.when(F.col("event_id") % 20 == 1, F.col("cents") + F.col("k")).otherwise(
        F.col("cents")
    )
    rows = as_transactions(copies.withColumn("cents", shifted))
    return rows.withColumns(
        {
            "status": F.lit("SETTLED"),
            "file_date": F.date_add(F.col("executed_at").cast("date"), F.col("k")),
        }
    ).select(*TRANSACTION_COLUMNS, "file_date")


def customer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six snapshots of the customers, two weeks apart: tiers change, cities come and
    go, some customers are missing at times, and countries change without a version."""
    number = F.substring("customer_id", 2, 9).cast("bigint")
    run = F.col("run")
    rows = raw_customers(spark, sf_dir).withColumn(
        "run", F.explode(F.sequence(F.lit(0), F.lit(5)))
    )
    return (
        rows.filter((number + run * 3) % 9 != 0)
        .withColumns(
            {
                "risk_tier": F.when((number + run) % 5 == 0, "HIGH").otherwise(F.col("risk_tier")),
                "city": F.when((number * 7 + run) % 11 != 0, F.col("city")),
                "country": F.when((number + run) % 4 == 0, "BE").otherwise(F.col("country")),
                "run_ts": F.lit("2024-01-05").cast("timestamp_ntz")
                + F.make_dt_interval(days=run * 14),
            }
        )
        .select("run_ts", "customer_id", "address", "city", "country", "risk_tier", "created_at")
    )


def dirty_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged payments with faults of every kind planted in them."""
    number = F.col("event_id")
    hashed = F.sha2(F.concat(F.lit(KEY), F.col("sender_iban")), 256)
    amount = (F.col("cents").cast("decimal(18,0)") / 100).cast("decimal(18,2)")
    return as_transactions(ev(spark, sf_dir)).select(
        "event_id",
        F.when(number % 41 == 0, F.lit(None).cast("string"))
        .when(number % 37 == 1, F.concat(F.lit("T"), padded(number - 1, 10)))
        .otherwise(F.col("transaction_id"))
        .alias("transaction_id"),
        F.when(number % 43 == 0, F.left(hashed, F.lit(60)))
        .when(number % 53 != 0, hashed)
        .alias("sender_iban_hmac"),
        F.when(number % 59 == 0, -amount - 1)
        .when(number % 61 != 0, amount)
        .cast("decimal(18,2)")
        .alias("amount_eur"),
        F.when(number % 67 == 0, "LOST").when(number % 71 != 0, F.col("status")).alias("status"),
    )


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source customers that break keys, NOT NULL rules and length limits."""
    number = F.substring("customer_id", 2, 9).cast("bigint")
    return raw_customers(spark, sf_dir).select(
        F.when(number % 17 == 3, F.concat(F.lit("C"), padded(number - 3, 9)))
        .otherwise(F.col("customer_id"))
        .alias("customer_id"),
        F.when(number % 19 != 0, F.col("first_name")).alias("first_name"),
        F.when(number % 23 == 0, F.repeat(F.col("last_name"), 30))
        .otherwise(F.col("last_name"))
        .alias("last_name"),
        "email",
        "phone_number",
        F.when(number % 29 == 0, F.lit("FR00")).otherwise(F.col("iban")).alias("iban"),
        "address",
        "city",
        F.when(number % 31 == 0, "FRANCE").otherwise(F.col("country")).alias("country"),
        F.when(number % 37 != 0, F.col("risk_tier")).alias("risk_tier"),
        F.when(number % 41 != 0, F.col("created_at")).alias("created_at"),
    )


def event_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event feed as JSON text, with faulty events among the good ones."""
    number = F.col("event_id")
    rows = as_transactions(ev(spark, sf_dir))
    body = F.to_json(
        F.struct(
            "transaction_id",
            F.when(number % 19 != 0, F.col("sender_iban")).alias("sender_iban"),
            "beneficiary_iban",
            "amount",
            "currency",
            F.when(number % 17 == 0, "CHEQUE")
            .otherwise(F.col("payment_channel"))
            .alias("payment_channel"),
            F.when(number % 29 == 0, "LOST").when(number % 3 != 0, F.col("status")).alias("status"),
            F.when(number % 23 == 0, "not-a-time")
            .otherwise(F.col("executed_at").cast("string"))
            .alias("executed_at"),
        )
    )
    return rows.select(F.when(number % 97 == 5, "{oops").otherwise(body).alias("value"))
