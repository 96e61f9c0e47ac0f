"""The transaction event feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the topic of the feed.
TOPIC = "transactions"


def kafka_events(
    spark: SparkSession, servers: str, topic: str = TOPIC, per_trigger: int = 5_000_000
) -> DataFrame:
    """The feed from its earliest event, with ``value`` and an ``arrival`` order.

    ``per_trigger`` bounds a micro-batch. Offsets are kept in the checkpoint of
    the query. The arrival order is the offset: events that are published under
    their sender as key share a partition, where offsets are a total order. Needs
    the Kafka connector on the class path.
    """
    feed = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
    )
    return feed.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("arrival"))


def file_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = 1000,
    file_format: str = "parquet",
) -> DataFrame:
    """A folder (or glob) of event files as a stream, oldest file first.

    ``files_per_trigger`` bounds a micro-batch; None takes all files at once.
    """
    reader = spark.readStream.format(file_format).schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def publish(encoded: DataFrame, servers: str, topic: str = TOPIC) -> None:
    """Send ``key`` and ``value`` rows to the feed. Needs the Kafka connector."""
    (
        encoded.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
