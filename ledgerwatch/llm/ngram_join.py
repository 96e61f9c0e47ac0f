"""Exact Jaccard self-join of documents on word shingles, filtered under several token orders.

1. Blocks of documents send their shingle hashes to buckets, which answer with the number of
   documents of every shingle that has more than one. A document with fewer shared shingles
   than the threshold needs has no partner and leaves.
2. Every linked pair shares a shingle among the first ``n - ceil(t n) + 1`` of both, whatever the
   common order of all shingles. Three orders are used, all with rare shingles first, with
   ties broken by different hashes. The first gives candidates; they stay if they share a
   prefix shingle under the second and the third order too; the rest are compared exactly.
   A shared shingle counts only where enough shingles follow it in both for the threshold.
3. A group of documents with one prefix shingle is not expanded into pairs: those that are not
   yet connected with its leader are compared with it, in rounds with other leaders, while a
   round takes away a quarter of the pairs of unconnected documents and they are more than the
   documents in the groups. Only the pairs left are compared one by one. Components of the links found are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm import blocks as B
from ledgerwatch.llm.components import components, contracted, least_linked
from ledgerwatch.workspace import stage, stage_counted

WORDS, PERCENT = 5, 80
#: Rounds of comparing with leaders, at most; fewer once the pairs that are left are few.
TURNS = 6
#: Star steps on the links after a round. Labels may then be finer than components, never coarser.
STEPS = 2
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each row. A-Z count as a-z; words hold no byte of ``between``."""
    counts = np.zeros(len(offsets) - 1, np.int64)
    out = []
    lo = 0
    while lo < len(counts):
        hi = max(int(np.searchsorted(offsets, offsets[lo] + B.STEP, "right")) - 1, lo + 1)
        piece = data[offsets[lo] : offsets[hi]]
        inside = ~between[piece]
        at = offsets[lo:hi] - offsets[lo]
        first = np.zeros(len(piece), bool)
        first[at[at < len(piece)]] = True
        start = np.flatnonzero(inside & (first | ~np.r_[False, inside[:-1]]))
        last = np.zeros(len(piece), bool)
        ends = offsets[lo + 1 : hi + 1] - offsets[lo] - 1
        last[ends[ends >= 0]] = True
        end = np.flatnonzero(inside & (last | ~np.r_[inside[1:], False])) + 1
        counts[lo:hi] = np.searchsorted(start, ends + 1) - np.searchsorted(start, at)
        out.append(B.mix(B.run_values(_LOWER[piece], start, end) + (end - start).astype(np.uint64)))
        lo = hi
    return np.concatenate(out) if out else np.zeros(0, np.uint64), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct shingles, in order of both."""
    hashes, counts = word_hashes(data, offsets)
    first = np.cumsum(counts) - counts
    n = np.where(counts >= words, counts - words + 1, (counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(counts)), n)
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    size = np.minimum(counts, words)[row]
    code = np.zeros(len(at), np.uint64)
    for k in range(words):
        code = np.where(k < size, B.mix(code, k + 1) + padded[at + k], code)
    code = B.mix(code ^ size.astype(np.uint64), 9)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (code[1:] != code[:-1])] if len(row) else np.zeros(0, bool)
    return row[new], code[new]


def _key(code: np.ndarray, buckets: int) -> np.ndarray:
    bucket, rest = B.place(code, buckets)
    return (bucket.astype(np.uint64) << np.uint64(32)) | rest.astype(np.uint64)


def _count(words: int, buckets: int):
    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, code = shingle_sets(*B.utf8(table["text"]), words)
        slot, times = np.unique(_key(code, buckets), return_counts=True)
        rest = (slot & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        times = np.minimum(times, 255).astype(np.uint8)
        return B.messages(
            [
                (b, key[0].as_py(), B.pack(B.planes(rest[i:j], 4), times[i:j].tobytes()))
                for b, i, j in B.slices((slot >> np.uint64(32)).astype(np.int64))
            ]
        )

    return run


@B.frugal
def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    parts = [B.unpack(d) for d in table["data"].to_pylist()]
    rest = np.concatenate([B.unplanes(p[0], 4, np.uint32) for p in parts])
    times = np.concatenate([np.frombuffer(p[1], np.uint8) for p in parts]).astype(np.int64)
    order = np.argsort(rest, kind="stable")
    at = np.flatnonzero(np.r_[True, rest[order][1:] != rest[order][:-1]])
    total = np.empty(len(rest), np.int64)
    total[order] = np.repeat(np.add.reduceat(times[order], at), np.diff(np.r_[at, len(rest)]))
    rows, end = [], 0
    for block, p in zip(table["block"].to_pylist(), parts):
        start, end = end, end + len(p[1])
        pick = np.flatnonzero(total[start:end] > 1) + start
        if len(pick):
            rows.append((key[0].as_py(), block, B.pack(B.planes(rest[pick], 4), B.planes(total[pick], 5))))
    return B.messages(rows)


SETS = "id long, n long, sig string, codes binary, one array<long>, two binary, three binary"


def _prefixes(words: int, percent: int, buckets: int):
    """Per block: each document's set size, and if it may have partners its shared shingles and prefixes."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        ids = docs["id"].to_pylist()
        row, code = shingle_sets(*B.utf8(docs["text"]), words)
        slots, known = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for bucket, data in zip(answers["bucket"].to_pylist(), answers["data"].to_pylist()):
            a, b = B.unpack(data)
            slots.append((np.uint64(bucket) << np.uint64(32)) | B.unplanes(a, 4, np.uint32).astype(np.uint64))
            known.append(B.unplanes(b, 5, np.int64))
        slot = np.concatenate(slots)
        order = np.argsort(slot)
        hit, at = B.find(slot[order], _key(code, buckets))
        df = np.where(hit, np.concatenate(known)[order][at] if len(order) else 0, 1)
        size = np.bincount(row, minlength=len(ids))
        shared = np.bincount(row[df > 1], minlength=len(ids))
        start = np.cumsum(size) - size
        out = {k: [] for k in ("id", "n", "sig", "codes", "one", "two", "three")}
        seen: set[str] = set()
        for i, (n, s, m) in enumerate(zip(size.tolist(), start.tolist(), shared.tolist())):
            need = -(-percent * n // 100)
            sig = codes = one = two = three = None
            if n and m >= need:
                every, often = code[s : s + n], df[s : s + n]
                sums = (int(every.sum(dtype=np.uint64)), int(B.mix(every, 5).sum(dtype=np.uint64)))
                sig = f"{sums[0]:016x}{sums[1]:016x}"
                if sig not in seen:
                    seen.add(sig)
                    c, o = every[often > 1], often[often > 1]
                    left = n - need + 1 - (n - m)  # of the prefix, the rarest are in one document only
                    level = np.log2(o).astype(np.int64)
                    codes = c.tobytes()
                    one = c[np.lexsort((c, o))[:left]].astype(np.int64).tolist()
                    two, three = (np.sort(c[np.lexsort((B.mix(c, k), level))[:left]]).tobytes() for k in (6, 7))
            for k, v in zip(out, (ids[i], n, sig, codes, one, two, three)):
                out[k].append(v)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    return run


def _common(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            keep = []
            for i, (x, y) in enumerate(zip(rows["x_n"], rows["y_n"])):
                if _common(rows["x_two"][i], rows["y_two"][i]) and _common(rows["x_three"][i], rows["y_three"][i]):
                    both = _common(rows["x_codes"][i], rows["y_codes"][i])
                    if 100 * both >= percent * (x + y - both):
                        keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([rows[k][i] for i in keep], pa.string()) for k in ("a", "b")], names=["a", "b"]
            )

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) that pass the other orders and the exact comparison."""
    side = lambda p, at: sets.select(F.col("sig").alias(at), *[F.col(c).alias(f"{p}_{c}") for c in ("n", "codes", "two", "three")])
    both = pairs.join(side("x", "a"), "a").join(side("y", "b"), "b")
    return both.mapInArrow(_verify(percent), "a string, b string")


def linked_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents (``id``, ``n``, ``sig``), classes (``sig``, ``id``, ``n``) and links between classes (``a``, ``b``).

    Documents with equal shingle sets are a class. The components of the links are those of
    all pairs of classes at Jaccard ``percent`` or more; some links are paths of such pairs.
    """
    spark = docs.sparkSession
    text: Column = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    n, buckets = B.counts(spark, docs, text)
    blocks = docs.select(B.block_of(n, docs[id_col], text).alias("block"), docs[id_col].cast("long").alias("id"), text.alias("text"))
    asked = blocks.groupBy("block").applyInArrow(_count(words, buckets), B.MESSAGE)
    answers = asked.groupBy("bucket").applyInArrow(_answer, B.MESSAGE)
    every = stage(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_prefixes(words, percent, buckets), SETS), "shingles")
    least = F.min(F.coalesce("id", F.lit(B.LAST))).alias("id")
    sets = every.where("sig is not null").groupBy("sig").agg(
        least, F.count(F.lit(1)).alias("docs"), *[F.first(c, ignorenulls=True).alias(c) for c in ("n", "codes", "one", "two", "three")]
    )
    sets = stage(sets, "classes")
    # A pair's first common token bounds what it has in common by what follows on either side.
    need = F.ceil(F.col("n") * percent / 100)
    tokens = sets.select("sig", "n", "docs", (need + F.size("one") - 1).alias("whole"), F.posexplode("one").alias("k", "token"))
    tokens = stage(tokens.select("sig", "n", "docs", (F.col("whole") - F.col("k")).alias("most"), "token"), "prefixes")
    close = F.expr(
        f"least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}"
        f" and least(x.most, y.most) * (100 + {percent}) >= {percent} * (x.n + y.n)"
    )
    marks = tokens.withColumn("label", F.col("sig"))
    links, before = None, float("inf")
    for turn in range(TURNS):
        # The class of most documents is the likeliest original of the others. First one leader
        # for all groups a document is in, then others for each of them.
        draw = F.xxhash64("sig", *([F.lit(turn), F.col("token")] if turn else []))
        rank = F.struct((-F.col("docs") if turn == 0 else F.lit(0)).alias("c"), draw.alias("r"), "sig", "n", "most", "label")
        leaders = marks.groupBy("token").agg(F.min(rank).alias("leader")).select("token", "leader.*")
        x, y = marks.alias("x"), leaders.alias("y")
        pairs = x.join(y, F.expr("x.token = y.token and x.label <> y.label") & close)
        pairs = pairs.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct()
        more = _linked(pairs, sets, percent)
        links = contracted(more if links is None else links.unionByName(more), STEPS)
        roots = least_linked(links).withColumnRenamed("node", "who")
        marks = marks.drop("label").join(roots, F.col("sig") == F.col("who"), "left")
        marks = marks.select("sig", "n", "docs", "most", "token", F.coalesce("root", "sig").alias("label"))
        held = marks.groupBy("token", "label").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("same"))
        held = stage(held.where("all * all > same").select(F.col("token").alias("t"), ((F.col("all") * F.col("all") - F.col("same")) / 2).alias("pairs")), "mixed")
        marks, left = stage_counted(marks.join(held, marks.token == held.t, "left_semi"), "prefixes")
        now = held.agg(F.sum("pairs")).first()[0] or 0
        if now <= left or now > 0.75 * before:
            break
        before = now
    x, y = marks.alias("x"), marks.alias("y")
    rest = x.join(y, F.expr("x.token = y.token and x.sig < y.sig and x.label <> y.label") & close)
    rest = rest.select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b")).distinct()
    links = links.unionByName(_linked(rest, sets, percent))
    return every.select("id", "n", "sig"), sets.select("sig", "id", "n"), links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``id``, ``n_shingles`` and ``component_id`` for every row of ``docs``.

    A set holds the distinct shingles of ``words`` words; a shorter text is one shingle, and
    a text without words, or null, has none and no links. ``component_id`` is the smallest
    id reachable by links, itself included; a null id is reported as null, and is never
    the smallest unless all others are null too. Repeated rows give equal rows.
    """
    every, classes, links = linked_documents(docs, id_col, text_col, words, percent)
    roots = components(links)
    named = classes.join(roots, classes.sig == roots.node, "left").select("sig", "id", F.coalesce("root", "sig").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    named = named.select("sig", "root").join(least, "root").select(F.col("sig").alias("class"), "component_id")
    out = every.join(named, every.sig == named["class"], "left")
    known = F.when(F.col("component_id") < B.LAST, F.col("component_id"))
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce(known, "id").alias("component_id"))


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, and all rows without an id."""
    found = near_duplicates(docs, id_col, text_col).where("id <> component_id").select(F.col("id").alias("gone")).distinct()
    return docs.join(found, docs[id_col] == found["gone"], "left_anti")
