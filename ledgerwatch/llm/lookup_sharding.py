"""Shard placement by a lookup table that the shards fill in turns.

Every shard has a permutation of the table's slots, from an offset and a step by two hashes
of its name; the table's size is a prime, so any step visits all slots. The shards take
turns, each claiming the next free slot it prefers, until the table is full. Shares
differ by one slot at most, and a lost shard moves few other documents. A document's
slot is its hash modulo the prime, so its place is one step in a table of fixed size.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prime, and at least a hundred times the shards: shares then differ by a hundredth at most.
SLOTS = 65_537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(kind: str, name: str) -> int:
    return int(hashlib.md5(f"{kind}|{name}".encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names")
    if not is_prime(slots) or slots < len(shards):
        raise ValueError("the number of slots must be a prime that is no less than the shards")
    place = [_number("offset", s) % slots for s in shards]
    step = [_number("step", s) % (slots - 1) + 1 if slots > 2 else 1 for s in shards]
    table, free = [-1] * slots, slots
    while True:
        for i in range(len(shards)):
            while table[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            table[place[i]] = i
            free -= 1
            if not free:
                return table


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``slot`` and ``shard``: as many rows as slots, whatever the documents."""
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(fill(shards, slots))], "slot long, shard string")


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key; null is a key like the empty text."""
    head = F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    return F.pmod(head, F.lit(slots))


def assign(docs: DataFrame, key: Column, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``row`` (all columns of ``docs``), ``slot`` and ``shard``. No shuffle.

    Equal keys share a shard, and so do all null and empty ones; use a key that
    is spread, such as the id. The table that is broadcast has a fixed size.
    """
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), slot_of(key, slots).alias("slot"))
    table = lookup_table(docs.sparkSession, shards, slots)
    return keyed.join(F.broadcast(table), "slot").select("row", "slot", "shard")


def write_shards(docs: DataFrame, key: Column, path: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, files: int = 8) -> None:
    """Parquet folders ``shard=...`` below ``path``. Each shard is spread over ``files`` tasks."""
    placed = assign(docs, key, shards, slots).select("row.*", "shard", "slot")
    placed.repartition(len(shards) * files, "shard", F.col("slot") % files).drop("slot").write.partitionBy("shard").parquet(path)
