"""Exact ranked search of all documents for a set of items, with geometric blocks in each posting list.

1. The items' terms are the vocabulary. One pass over the documents gives each its length and its
   vector: how often it holds each term of the vocabulary. Document counts and lengths are summed over all.
2. Tasks take their vectors in shares of bounded size. In a share the documents are clustered by the direction of their
   weighted vectors. Each term's posting list is put in order of the clusters and cut into
   blocks, so that a block holds documents that are alike, and a block's summary is the largest
   impact of every term in it, coordinate by coordinate.
3. An item goes through the lists of its terms, weightiest first. The weights times a block's
   summary bound every score in it; the block is read unless that is below the item's tenth best
   score so far. Terms whose lists are done no longer count in a bound, as their documents
   have been judged there, and the lists end when all terms left cannot reach the tenth best.

All scores and bounds are integers and a block at the limit is read, so nothing is lost. Each task
keeps the best of its own documents, and the last step ranks these. Terms are known by a
64-bit hash with their length; the vocabulary is a block of items, so that two of its terms and those of
a document have to agree by chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerwatch.llm import blocks as B
from ledgerwatch.llm.ngram_join import word_hashes
from ledgerwatch.workspace import stage, stage_counted

BEST = 10
#: Pairs of item and term that are searched for at a time. They are sent to all tasks: 24 bytes each.
PAIRS_AT_ONCE = 1 << 18
#: Entries of the vectors in one share, and documents of a block and of a cluster.
SHARE, BLOCK, CLUSTER = 1 << 20, 32, 64
#: Numbers that stand for a document's direction.
SKETCH = 16
#: Bytes of summaries that a share keeps for the next items, and of one that is made for all items of a term.
KEPT, WIDE = 64 << 20, 8 << 20
#: Blocks that are read before the limit is looked at again.
AT_ONCE = 16
#: White space and punctuation of ASCII: all that is no term.
_NO_TERM = np.array([c < 0x80 and not chr(c).isalnum() for c in range(256)])


def weight(documents: int, holding: int) -> int:
    """Of a term that so many of all documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(times: np.ndarray, length: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a weight is multiplied with, for a term's occurrences in a document of so many terms."""
    m = 100 - 90 + (90 * length * documents) // max(total, 1)
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes, counts = word_hashes(*B.utf8(pa.chunked_array([batch["text"]])), _NO_TERM)
        row = np.repeat(np.arange(len(counts)), counts)
        yield pa.RecordBatch.from_arrays([batch["id"].take(pa.array(row)), pa.array(hashes.view(np.int64))], names=["id", "term"])


def _vectors(vocabulary: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, counts = word_hashes(*B.utf8(pa.chunked_array([batch["text"]])), _NO_TERM)
            hit, at = B.find(vocabulary, hashes)
            key = np.repeat(np.arange(len(counts)), counts)[hit] * max(len(vocabulary), 1) + at[hit]
            key, times = np.unique(key, return_counts=True)
            row, term = np.divmod(key, max(len(vocabulary), 1))
            ends = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(counts)))].astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (term, times)]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(counts), *lists], names=["id", "n", "terms", "times"])

    return run


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Share:
    """The posting lists of some documents, in blocks of similar ones."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, term: np.ndarray, impact: np.ndarray, weights: np.ndarray, askers: list[np.ndarray]):
        self.ids, self.sizes, self.term, self.impact, self.askers = ids, sizes, term, impact, askers
        self.start = np.cumsum(sizes) - sizes
        doc = np.repeat(np.arange(len(ids)), sizes)
        order = np.lexsort((doc, self._clusters(weights)[doc], term))
        #: Documents of all lists, one list after the other, similar ones side by side.
        self.listed = doc[order]
        self.bound = np.searchsorted(term[order], np.arange(len(weights) + 1))
        full = np.flatnonzero(np.diff(self.bound))
        self.largest = np.zeros(len(weights), np.int64)
        if len(full):
            self.largest[full] = np.maximum.reduceat(impact[order], self.bound[full])
        self.column = np.full(len(weights), -1, np.int64)
        self.summaries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.kept = self.read = self.skipped = 0

    def _clusters(self, weights: np.ndarray) -> np.ndarray:
        """The nearest of some of the documents, by the angle between sketches of weighted vectors."""
        value = (weights[self.term] * self.impact).astype(np.float32)
        sketch = np.empty((len(self.ids), SKETCH), np.float32)
        for k in range(SKETCH):
            sign = np.random.default_rng(k).choice(np.array([-1, 1], np.float32), len(weights))
            sketch[:, k] = np.add.reduceat(value * sign[self.term], self.start)
        sketch /= np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        heads = sketch[:: CLUSTER]
        return np.concatenate([np.argmax(sketch[k : k + 4096] @ heads.T, axis=1) for k in range(0, len(sketch), 4096)])

    def _summary(self, term: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms in order, and the largest impact of each in every block of the list."""
        if term in self.summaries:
            return self.summaries[term]
        docs = self.listed[self.bound[term] : self.bound[term + 1]]
        blocks = -(-len(docs) // BLOCK)
        columns = self.askers[term]
        whole = blocks * len(columns) * 4 <= WIDE
        columns = columns if whole else np.sort(wanted)
        at = _ranges(self.start[docs], self.sizes[docs])
        block = np.repeat(np.arange(len(docs)) // BLOCK, self.sizes[docs])
        self.column[columns] = np.arange(len(columns))
        column = self.column[self.term[at]]
        self.column[columns] = -1
        own = column >= 0
        out = np.zeros((blocks, len(columns)), np.int32)
        np.maximum.at(out, (block[own], column[own]), self.impact[at[own]].astype(np.int32))
        if whole:
            if self.kept > KEPT:
                self.summaries, self.kept = {}, 0
            self.summaries[term], self.kept = (columns, out), self.kept + out.nbytes
        return columns, out

    def search(self, terms: np.ndarray, weights: np.ndarray, best: tuple[np.ndarray, np.ndarray], most: int, dense: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the best documents so far and here. ``terms`` come with the weightiest first; ``dense`` has the weights by term."""
        limit = lambda: max(int(best[0][most - 1]), 1) if len(best[0]) == most else 1
        reach = np.cumsum((weights * self.largest[terms])[::-1])[::-1]
        seen = np.zeros(len(self.ids), bool)
        for k, term in enumerate(terms.tolist()):
            if reach[k] < limit():
                break
            if self.bound[term] == self.bound[term + 1]:
                continue
            columns, summary = self._summary(term, terms)
            bounds = summary[:, np.searchsorted(columns, terms[k:])].astype(np.int64) @ weights[k:]
            order, at = np.argsort(-bounds, kind="stable"), 0
            while at < len(order) and bounds[order[at]] >= limit():
                some = order[at : at + AT_ONCE]
                some = some[bounds[some] >= limit()]
                first = self.bound[term] + some * BLOCK
                docs = self.listed[_ranges(first, np.minimum(first + BLOCK, self.bound[term + 1]) - first)]
                docs = docs[~seen[docs]]
                seen[docs] = True
                if len(docs):
                    entry = _ranges(self.start[docs], self.sizes[docs])
                    size = self.sizes[docs]
                    score = np.add.reduceat(dense[self.term[entry]] * self.impact[entry], np.cumsum(size) - size)
                    good = score >= limit()
                    score, ids = np.r_[best[0], score[good]], np.r_[best[1], self.ids[docs[good]]]
                    top = np.lexsort((ids, -score))[:most]
                    best = score[top], ids[top]
                at += len(some)
                self.read += len(some)
            self.skipped += len(order) - at
        return best


def _search(items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, documents: int, total: int, most: int):
    askers = [[] for _ in weights]
    for _, terms in items:
        for t in terms.tolist():
            askers[t].append(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [np.unique(np.concatenate(a)) if a else np.zeros(0, np.int64) for a in askers]
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        dense = np.zeros(len(weights), np.int64)

        def take(part: pa.Table) -> None:
            length, terms, times = (part[c].combine_chunks() for c in ("n", "terms", "times"))
            sizes = terms.value_lengths().to_numpy().astype(np.int64)
            term, times = (x.flatten().to_numpy().astype(np.int64) for x in (terms, times))
            share = Share(B.ids(part["id"]), sizes, term, impacts(times, np.repeat(length.to_numpy(), sizes), documents, total), weights, asked)
            for k, (_, own) in enumerate(items):
                dense[own] = weights[own]
                best[k] = share.search(own, weights[own], best[k], most, dense)
                dense[own] = 0

        held, size = [], 0
        for batch in batches:
            lo, ends = 0, np.cumsum(batch["terms"].value_lengths().to_numpy().astype(np.int64))
            while lo < batch.num_rows:
                before = int(ends[lo - 1]) if lo else 0
                hi = max(int(np.searchsorted(ends, before + SHARE - size, "right")), lo + 1)
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - before
                lo = hi
                if size >= SHARE or lo < batch.num_rows:
                    take(pa.Table.from_batches(held))
                    held, size = [], 0
        if held:
            take(pa.Table.from_batches(held))
        for (item, _), (score, ids) in zip(items, best):
            if len(score):
                known = pa.array(ids, mask=ids == B.LAST)
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(ids), pa.int64()), known, pa.array(score)], names=["item", "id", "score"])

    return run


def ranked(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", most: int = BEST
) -> DataFrame:
    """``item``, ``rank``, ``id`` and ``score`` of each item's ``most`` best documents with a score above 0.

    Equal scores are ranked by id, a null id last; of equal rows of one id each has a rank of its own.
    Rows of one item id are one item with the terms of all. An item without terms, or whose terms
    no document holds, has no rows; nor has any if either table is empty. A null or empty text has no terms. Other columns are not
    looked at.
    """
    asked = items.select(items[item_col].cast("long").alias("id"), F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text"))
    asked, pairs = stage_counted(asked.mapInArrow(_terms, "id long, term long").distinct(), "item-terms")
    given = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    groups = max(-(-pairs // PAIRS_AT_ONCE), 1)
    found = [_best_of(given, asked.where(F.pmod(F.xxhash64("id"), F.lit(groups)) == k), most) for k in range(groups)]
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    every = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order))
    return every.where(F.col("rank") <= most).select("item", "rank", "id", "score")


def _best_of(given: DataFrame, asked: DataFrame, most: int) -> DataFrame:
    rows = asked.toArrow()
    term = rows["term"].to_numpy().view(np.uint64)
    vocabulary = np.unique(term)
    vectors = stage(given.mapInArrow(_vectors(vocabulary), "id long, n long, terms array<int>, times array<int>"), "vectors")
    documents, total = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = np.zeros(len(vocabulary), np.int64)
    # One row for each term of the vocabulary, summed before and after the shuffle.
    for t, n in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toLocalIterator():
        holding[t] = n
    weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
    own: dict[int | None, list[int]] = {}
    for item, t in zip(rows["id"].to_pylist(), np.searchsorted(vocabulary, term).tolist()):
        own.setdefault(item, []).append(t)
    lists = [(item, np.array(sorted(t, key=lambda t: (-weights[t], t)), np.int64)) for item, t in own.items()]
    search = _search(lists, weights, documents, total, most)
    return vectors.where(F.size("terms") > 0).mapInArrow(search, "item long, id long, score long")
