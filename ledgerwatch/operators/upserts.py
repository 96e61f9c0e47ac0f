"""Keyed changes to operational tables, as whole-table DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwatch.workspace import stage


def _top_row(df: DataFrame, key: Sequence[str], order: list[Column]) -> DataFrame:
    # With a rank limit of one Spark keeps a single row per key in every task before
    # the shuffle, so the copies of a hot key never meet in one place.
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the first by ``order``, ties decided by the other columns."""
    rest = [name for name in df.columns if name not in order]
    return _top_row(df, key, [F.asc(name) for name in [*order, *rest]])


def last_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One whole row per key: the last by ``order``, ties decided by the other columns."""
    rest = [name for name in df.columns if name not in order]
    return _top_row(df, key, [F.desc(name) for name in [*order, *rest]])


def _has_null(key: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.col(name).isNull() for name in key])


def apply_block_decisions(transactions: DataFrame, decisions: DataFrame) -> DataFrame:
    """Set status and reason of every decided transaction; the latest decision wins.

    The old status does not matter, and decisions on unknown ids have no effect.
    """
    latest = last_per_key(
        decisions.select("transaction_id", "decided_at", "blocked_reason"),
        ["transaction_id"],
        ["decided_at"],
    ).select("transaction_id", F.lit(True).alias("_decided"), F.col("blocked_reason").alias("_why"))
    joined = transactions.join(latest, "transaction_id", "left")
    changed = {
        "status": F.when(F.col("_decided"), "BLOCKED").otherwise(F.col("status")),
        "blocked_reason": F.when(F.col("_decided"), F.col("_why")).otherwise(
            F.col("blocked_reason")
        ),
    }
    return joined.withColumns(changed).select(*transactions.columns)


def absent_rows(
    target: DataFrame, incoming: DataFrame, any_of: Sequence[Sequence[str]], arrival: str
) -> DataFrame:
    """The incoming rows that inserting one by one, in arrival order, would add.

    ``any_of`` lists the unique keys. A row is skipped if a row of the target, or
    an earlier row that was itself added, has the same value in any of them. As in a
    unique index, a key with a NULL in it conflicts with nothing. ``arrival`` is unique
    and not NULL, as in the source tables; an error is raised where that stops the work.
    """
    if len(any_of) == 1:
        key = list(any_of[0])
        free = _has_null(key)
        first = first_per_key(incoming.filter(~free), key, [arrival]).join(target, key, "left_anti")
        return first.unionByName(incoming.filter(free).select(*first.columns))

    undecided = incoming
    for key in any_of:
        undecided = undecided.join(target.select(*key), list(key), "left_anti")
    undecided = stage(undecided, "absent")
    added = []
    # A row that is the first of all its keys is added, and decides every row that
    # shares a key with it. Rows that lost only to a skipped row get their turn in
    # the next round, so the rounds follow the longest chain of such rows.
    while not undecided.isEmpty():
        winners = undecided
        for key in any_of:
            # Joined on the unique arrival, so a hot key does not skew the join.
            first = undecided.filter(~_has_null(key)).groupBy(*key).agg(F.min(arrival).alias(arrival))
            first = first.select(arrival, F.lit(True).alias("_first"))
            winners = winners.join(first, arrival, "left").filter(F.col("_first") | _has_null(key)).drop("_first")
        winners = stage(winners.select(*incoming.columns), "absent")
        if winners.isEmpty():
            raise ValueError(f"no row can be the first: {arrival} is NULL or not unique")
        added.append(winners)
        rest = undecided.join(winners.select(arrival), arrival, "left_anti")
        for key in any_of:
            rest = rest.join(winners.select(*key), list(key), "left_anti")
        undecided = stage(rest.select(*incoming.columns), "absent")
    empty = undecided.select(*incoming.columns)
    return reduce(DataFrame.unionByName, added, empty)


def insert_absent(
    target: DataFrame, incoming: DataFrame, any_of: Sequence[Sequence[str]], arrival: str
) -> DataFrame:
    """The target after inserting ``incoming`` row by row, skipping key conflicts."""
    added = absent_rows(target, incoming, any_of, arrival)
    return target.unionByName(added.select(*target.columns))
