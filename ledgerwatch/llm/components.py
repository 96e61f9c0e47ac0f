"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.workspace import stage_counted


def contracted(links: DataFrame, steps: int | None = None) -> DataFrame:
    """Links (``a`` > ``b``) with the same components as ``links`` (``a``, ``b``), after star steps.

    Large-star and small-star steps in turn, ``steps`` of them or until nothing changes, when
    every node is linked with the least of its component alone. Each step joins
    every node to the least of its neighbours, so a long chain halves, and the number
    of links never grows. Steps are written to the shared folder: the lineage stays
    short, and no executor holds the only copy. Every minimum is combined before its
    shuffle, and a node with very many links is split by the join.
    """
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links, before = stage_counted(links, "links")
    seen, step = None, 0
    while before and step != steps:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
        small = large.join(least, large.a == least.n)
        small = small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        links, count = stage_counted(small.where("a <> b").distinct(), "links")
        step += 1
        if steps is None:
            now = (count, links.agg(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[0])
            if now == seen:
                break
            seen = now
    return links


def least_linked(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least of itself and what it is linked with below, for every node of contracted links."""
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")))
    return ends.groupBy("node").agg(F.min("root").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node it reaches, for every node of ``links`` (``a``, ``b``)."""
    return least_linked(contracted(links))
