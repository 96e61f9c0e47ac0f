"""Near-duplicate vectors by spherical-cap filters from a structured random product code.

The dimensions are turned by a random rotation and cut into ``PARTS`` parts, each with ``WORDS``
random directions. A filter is one direction of each part; its inner product with a
vector is the sum over the parts, so the filters above a threshold are listed from
the parts' scores without trying all ``WORDS ** PARTS``. Near vectors are above many of
the same filters and meet there. Every vector keeps at least its ``LEAST`` best filters, so
none is left out by the code's luck. Pairs that meet are compared in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.components import components
from ledgerwatch.workspace import stage

PARTS, WORDS = 4, 48
#: Threshold in units of a random inner product's deviation.
HEIGHT = 4.6
LEAST = 24
COSINE = 0.98
#: Vectors of a filter that one task compares with as many others.
CHUNK = 1024
SEED = 71


def code(dim: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation, and the directions of each part."""
    rng = np.random.default_rng(SEED + dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    cuts = np.array_split(np.arange(dim), min(PARTS, dim))
    words = []
    for cut in cuts:
        w = rng.standard_normal((WORDS, len(cut)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True) * np.sqrt(len(cut)))
    return rotation, words


def list_filters(vectors: np.ndarray) -> list[np.ndarray]:
    """For each unit vector the filters above ``HEIGHT``, or its ``LEAST`` best, in order of their numbers."""
    rotation, words = code(vectors.shape[1])
    turned = vectors @ rotation
    scores, at = [], 0
    for w in words:
        scores.append(turned[:, at : at + w.shape[1]] @ w.T)
        at += w.shape[1]
    # Meet in the middle: sums over the first and over the second half of the parts.
    half = (len(scores) + 1) // 2
    out = []
    for i in range(len(vectors)):
        left, right = (_sums([s[i] for s in side]) for side in (scores[:half], scores[half:]))
        order = np.argsort(right)
        ranked = right[order]
        height = HEIGHT
        while True:
            need = np.searchsorted(ranked, height - left)
            rows = np.flatnonzero(need < len(ranked))
            sizes = len(ranked) - need[rows]
            total = int(sizes.sum())
            if total >= min(LEAST, len(left) * len(right)):
                break
            height -= 0.15
        inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(need[rows], sizes)
        first = np.repeat(rows, sizes)
        found = first * len(right) + order[inside]
        if height < HEIGHT and total > LEAST:
            found = found[np.argsort(-(left[first] + ranked[inside]), kind="stable")[:LEAST]]
        out.append(np.sort(found).astype(np.int64))
    return out


def _sums(scores: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(1)
    for s in scores:
        total = (total[:, None] + s[None, :]).reshape(-1)
    return total


def _filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        by_dim: dict[int, list[int]] = {}
        for i, v in enumerate(rows["v"]):
            by_dim.setdefault(len(v), []).append(i)
        out: list = [None] * len(rows["v"])
        for pick in by_dim.values():
            x = np.array([rows["v"][i] for i in pick], np.float64)
            for i, f in zip(pick, list_filters(x / np.linalg.norm(x, axis=1, keepdims=True))):
                out[i] = f
        yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(out, pa.list_(pa.int64()))], names=["key", "filters"])


def _first_common(a: np.ndarray, b: np.ndarray, here: int) -> bool:
    """Whether ``here`` is the least filter of both lists."""
    both = np.intersect1d(a, b, assume_unique=True)
    return bool(len(both)) and both[0] == here


def _compare(cosine: float):
    """Links of one filter's two chunks: for each class its linked vectors, and one path to a common class."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, here, first, second = (k.as_py() for k in key)
        chunk, weight = table["chunk"].to_numpy(), table["copies"].to_numpy()
        names = np.array(table["key"].to_pylist(), object)
        x = np.array(table["v"].to_pylist(), np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        lists = [np.array(f, np.int64) for f in table["filters"].to_pylist()]
        a, b = np.flatnonzero(chunk == first), np.flatnonzero(chunk == second)
        linked, parent = np.zeros(len(names), np.int64), np.arange(len(names))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for lo in range(0, len(a), 256):
            rows = a[lo : lo + 256]
            close = x[rows] @ x[b].T >= cosine
            for i, near in zip(rows.tolist(), close):
                for j in b[near].tolist():
                    # A pair is counted in one filter only, and within a chunk from one side only.
                    if i != j and (first != second or i < j) and _first_common(lists[i], lists[j], here):
                        linked[i] += weight[j]
                        linked[j] += weight[i]
                        p, q = root(i), root(j)
                        parent[max(p, q)] = min(p, q)
        pick = np.flatnonzero(linked)
        roots = [names[root(i)] for i in pick.tolist()]
        return pa.table({"key": pa.array(names[pick], pa.string()), "n": pa.array(linked[pick]), "to": pa.array(roots, pa.string())})

    return run


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """``id``, ``n_links``, ``component_id`` and ``kept`` for every row of ``vectors``.

    Rows with one label and one vector are a class, compared once and counted with its rows.
    Rows without label, and vectors that are null, empty, zero or hold null or non-finite
    components, link with nothing. Vectors of different length never link. A null id
    gives a null component unless it reaches an id; it is kept if nothing smaller is reached.
    """
    v = F.transform(F.col("v"), lambda x: x.cast("double"))
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[label_col].alias("label"), vectors[vector_col].alias("v")).withColumn("v", v)
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    fine = F.coalesce(F.col("label").isNotNull() & fine, F.lit(False))
    # Adding zero makes the two zeros one, so equal vectors have equal digests.
    plain = F.transform("v", lambda x: x + F.lit(0.0))
    digest = F.sha2(F.concat_ws("|", F.col("label").cast("string"), F.array_join(plain.cast("array<string>"), ",")), 256)
    rows = rows.select("id", "label", "v", F.when(fine, digest).alias("digest"))
    least = F.min(F.coalesce("id", F.lit(2**63 - 1))).alias("least")
    classes = rows.where("digest is not null").groupBy("digest").agg(least, F.count(F.lit(1)).alias("copies"))
    # One row per class: its first row's id can be shared by classes only where ids repeat.
    one = rows.where("digest is not null").dropDuplicates(["digest"]).select(F.col("digest").alias("d"), "label", "v")
    classes = classes.join(one, classes.digest == one.d).select(F.substring("digest", 1, 32).alias("key"), "digest", "least", "copies", "label", "v")
    classes = stage(classes, "vector-classes")
    filters = stage(classes.select("key", "v").mapInArrow(_filters, "key string, filters array<long>"), "vector-filters")
    cells = filters.select("key", F.explode("filters").alias("filter")).join(classes.select("key", "label"), "key")
    sizes = cells.groupBy("label", "filter").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    sizes = sizes.select(F.col("label").alias("l"), F.col("filter").alias("f"), F.ceil(F.col("held") / CHUNK).alias("chunks"))
    met = cells.join(sizes, (cells.label == sizes.l) & (cells["filter"] == sizes.f)).select("key", "label", "filter", "chunks")
    met = met.withColumn("chunk", F.pmod(F.xxhash64("key", "filter"), "chunks"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0L, chunks - 1)")))
    met = met.select("key", "label", "filter", "chunk", F.least("chunk", "other").alias("first"), F.greatest("chunk", "other").alias("second"))
    met = met.join(classes.select("key", "copies", "v"), "key").join(filters, "key")
    found = met.groupBy("label", "filter", "first", "second").applyInArrow(_compare(cosine), "key string, n long, to string")
    found = stage(found, "vector-links")
    roots = components(found.select(F.col("key").alias("a"), F.col("to").alias("b")))
    counts = found.groupBy("key").agg(F.sum("n").alias("n"))
    named = classes.select("key", "digest", "least", "copies").join(roots, classes.key == roots.node, "left").join(counts, "key", "left")
    named = named.withColumn("root", F.coalesce("root", "key"))
    lowest = named.groupBy("root").agg(F.min("least").alias("lowest"))
    named = named.join(lowest, "root").select(F.col("digest").alias("d"), "copies", "n", "lowest")
    out = rows.select("id", "digest").join(named, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("lowest") < 2**63 - 1, F.col("lowest"))
    links = F.coalesce(F.col("copies") - 1 + F.coalesce("n", F.lit(0)), F.lit(0)).cast("long")
    out = out.select("id", links.alias("n_links"), F.coalesce(component, "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
