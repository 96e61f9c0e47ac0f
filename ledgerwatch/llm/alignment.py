"""Alignment of two tokenizers over the same bytes, by merging their token ends in lockstep.

Tokenizer A is a byte-level BPE that is given a space and the text; tokenizer B is a
SentencePiece model, which puts the space itself. Both spell the same bytes, so the ends of their
tokens are places in one string.

One NumPy state vector holds a pointer into A's and into B's ends for every document of a batch
(a long document has several entries, one per stretch of ``LANE`` bytes, so that it doesn't go on alone). Each step
writes the link of the two tokens it looks at, and a cut where both end; advances the pointer
whose token ends first, or both; and compacts the vector to the documents that go on. Cuts bound groups, and
every A token of a group is linked with every B token of it. What the merge has not met, pairs in
groups with several tokens on either side, is added from the distinct ids of the group.

How many documents hold a pair of ids linked is counted over the corpus. A block of documents
gives its distinct pairs as rows, with the number of its documents, which are summed by Spark and joined back to
the blocks that hold them: a pair that all documents hold is one row per block.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerwatch.llm import blocks as B
from ledgerwatch.llm.sentencepiece_codec import MARK
from ledgerwatch.workspace import stage

#: Bytes of a document that one entry of the state vector walks over.
LANE = 1024
#: Text that is encoded and merged at a time, and text of one block (both in bytes).
BATCH_BYTES, BLOCK_BYTES = 1 << 20, 6 << 20
#: Pairs of wide groups that are made at a time.
PAIRS = 1 << 20
#: A pair of ids as one number: A's id above the bits of B's.
BITS = 24


def byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones are themselves, the rest follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Spelling:
    """The bytes of every id of a vocabulary."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.size = np.array([len(e) for e in entries], np.int64)
        self.start = np.cumsum(self.size) - self.size

    def agrees(self, ids: np.ndarray, n: np.ndarray, whole: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of each text, ``n`` of the ids and ``length`` of the bytes: are its ids spelled like it?"""
        size, row = self.size[ids], np.repeat(np.arange(len(n)), n)
        good = np.bincount(row, size, len(n)).astype(np.int64) == length
        ids, size = ids[good[row]], size[good[row]]
        spelled = B.take_slices(self.data, self.start[ids], size)
        differs = np.flatnonzero(spelled != whole[np.repeat(good, length)])
        good[np.flatnonzero(good)[np.searchsorted(np.cumsum(length[good]), differs, "right")]] = False
        return good


class ByteBpe:
    """A byte-level BPE file. Ids in order of the merges are ranks, which the faster library takes; else the file's own one encodes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before, code = spec["model"], spec["pre_tokenizer"] or {}, byte_level()
        own = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = model["vocab"] | own
        entries = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            entries[i] = token.encode() if token in own else bytes(code[c] for c in token)
        self.spelling = Spelling(entries)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        plain = not spec["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain = plain and not model.get("ignore_merges") and not model.get("dropout")
        if plain and ids == list(range(256, 256 + len(ids))):
            import tiktoken
            from public_tokenizers import PATTERN

            ranks = {entries[i]: i for t, i in model["vocab"].items() if t not in own}
            library = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            self._encode = lambda text: library.encode_to_numpy(text, disallowed_special=())
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_file(path)
            library.encode_special_tokens = True
            self._encode = lambda text: library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each text, and ids per text; an empty text has none."""
        found = [np.asarray(self._encode(" " + t) if t else (), np.int64) for t in texts]
        return np.concatenate([np.zeros(0, np.int64), *found]), np.array([len(f) for f in found], np.int64)


class Pieces:
    """A SentencePiece model that puts the space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = own = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = map(own.id_to_piece, range(own.get_piece_size()))
        self.spelling = Spelling([bytes([int(p[3:5], 16)]) if own.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text, and ids per text."""
        found = self.library.encode(texts, num_threads=1)
        n = np.array(list(map(len, found)), np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, int(n.sum())), n


@lru_cache(maxsize=1)
def _tokenizers(a_path: str, b_path: str) -> tuple:
    a, b = ByteBpe(a_path), Pieces(b_path)
    # Texts of all ids with what may follow them in the text of the groups.
    after = [",", "|", ";", ""]
    texts = [f"{i}{x}" for own in (a, b) for i in range(len(own.spelling.size)) for x in after]
    return a, b, texts


def lockstep(end_a: np.ndarray, end_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A and B token of each link that the merge meets, in order, and whether a cut follows it.

    ``end_a`` and ``end_b`` rise through all documents, one after the other; entry ``k`` of the
    state vector goes from byte ``first[k]`` to ``last[k]``, and together they cover all bytes.
    """
    path = np.full(len(end_a) + len(end_b), -1, np.int64)
    cut = np.zeros(len(path), bool)
    i, j = np.searchsorted(end_a, first, "right"), np.searchsorted(end_b, first, "right")
    while len(i):
        a, b = end_a[i], end_b[j]
        at = i + j
        path[at] = i
        on_a, on_b = a <= b, b <= a
        cut[at] = on_a & on_b
        i, j = i + on_a, j + on_b
        more = np.minimum(a, b) < last
        if not more.all():
            i, j, last = i[more], j[more], last[more]
    at = np.flatnonzero(path >= 0)
    return path[at], at - path[at], cut[at]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Batch:
    """Some texts, encoded twice and aligned. Documents without tokens have no tokens, groups or links here."""

    def __init__(self, texts: list[str], data: np.ndarray, offsets: np.ndarray, a_path: str, b_path: str):
        one, two, self.names = _tokenizers(a_path, b_path)
        self.vocabulary = len(one.spelling.size)
        a, n_a = one.encode(texts)
        b, n_b = two.encode(texts)
        length = np.diff(offsets)
        length = length + (length > 0)
        whole = np.full(int(length.sum()), 0x20, np.uint8)
        whole[_ranges(np.cumsum(length) - length + 1, np.diff(offsets))] = data
        good = (length > 0) & one.spelling.agrees(a, n_a, whole, length) & two.spelling.agrees(b, n_b, whole, length)
        self.a, self.b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        self.n_a, self.n_b = n_a * good, n_b * good
        length = length * good
        ends = np.cumsum(length)
        lanes = -(-length // LANE)
        step = _ranges(np.zeros(len(lanes), np.int64), lanes) * LANE
        first = np.repeat(ends - length, lanes) + step
        last = np.minimum(first + LANE, np.repeat(ends, lanes))
        size_a, size_b = one.spelling.size[self.a], two.spelling.size[self.b]
        self.link_a, self.link_b, self.cut = lockstep(np.cumsum(size_a), np.cumsum(size_b), first, last)
        # The first token of each group that is not in it any more.
        self.to_a, self.to_b = self.link_a[self.cut] + 1, self.link_b[self.cut] + 1
        self.in_a, self.in_b = np.diff(self.to_a, prepend=0), np.diff(self.to_b, prepend=0)
        ends_a = np.cumsum(self.n_a)
        self.group_doc = np.searchsorted(ends_a, self.to_a - 1, "right")
        self.n_groups = np.bincount(self.group_doc, minlength=len(n_a))
        sizes = self.in_a * self.in_b
        total = np.r_[0, np.cumsum(sizes)]
        group_ends = np.cumsum(self.n_groups)
        self.n_links = total[group_ends] - total[group_ends - self.n_groups]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, pair of ids and number of links, distinct and in order of both."""
        wide = (self.in_a > 1) & (self.in_b > 1)
        group = np.cumsum(self.cut) - self.cut
        narrow = ~wide[group]
        parts = [self._counted(self.group_doc[group[narrow]], (self.a[self.link_a[narrow]] << BITS) | self.b[self.link_b[narrow]])]
        parts += [self._counted(*p) for p in self._wide_pairs(np.flatnonzero(wide))]
        return self._counted(*(np.concatenate(x) for x in zip(*parts))) if len(parts) > 1 else parts[0]

    def _wide_pairs(self, wide: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        sides = []
        for ids, to, size in ((self.a, self.to_a, self.in_a), (self.b, self.to_b, self.in_b)):
            key = (np.repeat(np.arange(len(wide)), size[wide]) << BITS) | ids[_ranges(to[wide] - size[wide], size[wide])]
            sides.append(np.unique(key, return_counts=True))
        (key_a, times_a), (key_b, times_b) = sides
        own = key_a >> BITS
        start = np.searchsorted(key_b >> BITS, own)
        size = np.searchsorted(key_b >> BITS, own, "right") - start
        until = np.cumsum(size)
        lo = 0
        while lo < len(own):
            hi = max(int(np.searchsorted(until, until[lo] - size[lo] + PAIRS, "right")), lo + 1)
            row, at = np.repeat(np.arange(lo, hi), size[lo:hi]), _ranges(start[lo:hi], size[lo:hi])
            low = (1 << BITS) - 1
            yield self.group_doc[wide[own[row]]], ((key_a[row] & low) << BITS) | (key_b[at] & low), times_a[row] * times_b[at]
            lo = hi

    @staticmethod
    def _counted(doc: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        known, slot = np.unique(pair, return_inverse=True)
        key = doc * max(len(known), 1) + slot
        if times is None:
            key, times = np.unique(key, return_counts=True)
        else:
            key, at = np.unique(key, return_inverse=True)
            times = np.bincount(at, times, len(key)).astype(np.int64)
        return key // max(len(known), 1), known[key % max(len(known), 1)] if len(known) else key, times

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups, ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        group_a, group_b = (np.repeat(np.arange(len(n)), n) for n in (self.in_a, self.in_b))
        after = np.zeros(len(self.a) + len(self.b), np.int64)
        order = np.zeros(len(after), np.int64)
        at_a = np.arange(len(self.a)) + (self.to_b - self.in_b)[group_a]
        at_b = np.arange(len(self.b)) + self.to_a[group_b]
        order[at_a], order[at_b] = self.a, self.b + self.vocabulary
        after[at_a[self.to_a - 1]], after[at_b[self.to_b - 1]] = 1, 2
        n = self.n_a + self.n_b
        ends = np.cumsum(n)
        after[ends[n > 0] - 1] = 3
        words = list(map(self.names.__getitem__, (4 * order + after).tolist()))
        return [
            hashlib.sha256("".join(words[e - k : e]).encode()).hexdigest() if k else "" for e, k in zip(ends.tolist(), n.tolist())
        ]


def _batches(table: pa.Table, a_path: str, b_path: str) -> Iterator[tuple[pa.Table, int, Batch]]:
    """Slices of some rows with their bytes of text, aligned."""
    data, offsets = B.utf8(table["text"])
    lo = 0
    while lo < len(table):
        hi = max(int(np.searchsorted(offsets, offsets[lo] + BATCH_BYTES, "right")) - 1, lo + 1)
        part = table.slice(lo, hi - lo)
        texts = [t or "" for t in part["text"].to_pylist()]
        yield part, int(offsets[hi] - offsets[lo]), Batch(texts, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], a_path, b_path)
        lo = hi


def _given(docs: DataFrame, text_col: str) -> DataFrame:
    others = [docs[c] for c in docs.columns if c != text_col]
    return docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), docs[text_col].cast("string").alias("text"))


def _optional(kind: T.DataType) -> T.DataType:
    """The type with fields that may be null, as in a row without a document."""
    return T.StructType([T.StructField(f.name, _optional(f.dataType)) for f in kind]) if isinstance(kind, T.StructType) else kind


def align_documents(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (without the text), with both encodings and their groups.

    ``a_ids`` and ``b_ids``; ``a_ends`` and ``b_ends``, how many of them come up to the end of each
    group. All are empty for a null or empty text, and for one that the tokens of either side
    do not spell byte by byte after a space. Works row by row, without a shuffle.
    """
    given = _given(docs, text_col)
    names = ("a_ids", "b_ids", "a_ends", "b_ends")
    schema = T.StructType([T.StructField("row", given.schema["row"].dataType), *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in names]])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, own in _batches(pa.Table.from_batches([batch]), a_path, b_path):
                base_a, base_b = ((np.cumsum(n) - n)[own.group_doc] for n in (own.n_a, own.n_b))
                lists = ((own.a, own.n_a), (own.b, own.n_b), (own.to_a - base_a, own.n_groups), (own.to_b - base_b, own.n_groups))
                columns = [part["row"].combine_chunks(), *[pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(n)].astype(np.int32)), pa.array(x.astype(np.int32))) for x, n in lists]]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return given.mapInArrow(run, schema)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _rising(values: np.ndarray) -> bytes:
    return B.planes(np.diff(values, prepend=0).astype(np.uint64), 7)


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(B.unplanes(data, 7, np.uint64).astype(np.int64))


def _encode(a_path: str, b_path: str, schema: pa.Schema):
    """Rows of documents, with their pairs as places in their block's list, and a row for each block's list."""

    def block_rows(block: int, held: list) -> Iterator[pa.RecordBatch]:
        known, docs = np.unique(np.concatenate([p for _, _, _, p, _, _ in held]), return_counts=True)
        for part, counts, doc, pair, times, digests in held:
            slot = np.searchsorted(known, pair)
            ends = np.searchsorted(doc, np.arange(len(part)), "right").tolist()
            starts = [0, *ends[:-1]]
            columns = {c: pa.array(n, pa.int64()) for c, n in zip(COUNTS, counts)}
            columns |= {"row": part["row"].combine_chunks(), "groups_sha256": pa.array(digests, pa.string()), "block": pa.array(np.full(len(part), block))}
            columns["slots"] = pa.array([_rising(slot[s:e]) for s, e in zip(starts, ends)], pa.binary())
            columns["times"] = pa.array([B.planes(times[s:e].astype(np.uint64), 8) for s, e in zip(starts, ends)], pa.binary())
            yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(len(part), f.type)).cast(f.type) for f in schema], schema=schema)
        columns = {"block": pa.array([block]), "pairs": pa.array([_rising(known)], pa.binary()), "docs": pa.array([B.planes(docs.astype(np.uint64), 8)], pa.binary())}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(1, f.type)).cast(f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for part, n_bytes, own in _batches(pa.Table.from_batches([batch]), a_path, b_path):
                held.append((part.select(["row"]), [getattr(own, c) for c in COUNTS], *own.pairs(), own.digests()))
                size += n_bytes
                if size >= BLOCK_BYTES:
                    yield from block_rows(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield from block_rows(block, held)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            pair = _risen(row["pairs"])
            columns = (np.full(len(pair), row["block"]), np.arange(len(pair)), pair, B.unplanes(row["docs"], 8, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=["block", "slot", "pair", "docs"])


def _sums(schema: pa.Schema):
    @B.frugal
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        slot, total, best = (answers[c].to_numpy().astype(np.int64) for c in ("slot", "total", "best"))
        table = np.zeros((2, len(slot)), np.int64)
        table[:, slot] = best, total
        found = np.zeros((2, len(docs)), np.int64)
        for k, (slots, times) in enumerate(zip(docs["slots"].to_pylist(), docs["times"].to_pylist())):
            found[:, k] = table[:, _risen(slots)] @ B.unplanes(times, 8, np.int64)
        columns = {"n_best": pa.array(found[0]), "count_sum": pa.array(found[1])}
        return pa.table([columns[f.name] if f.name in columns else docs[f.name].cast(f.type) for f in schema], schema=schema)

    return run


def linked_counts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (without the text), with figures of its alignment.

    ``n_a``, ``n_b``, ``n_groups``, ``n_links`` and ``groups_sha256``, the digest of its groups as
    text; ``count_sum``, over its links how many rows of ``docs`` hold the link's pair of ids; ``n_best``, links
    whose count is the highest of their A id, ties included. A null or empty text, and one that
    the tokens of either side do not spell, has zeros and an empty digest. Repeated
    rows are documents of their own; an empty table gives no rows; other columns may have any names.
    """
    given = _given(docs, text_col)
    number, blob = T.LongType(), T.BinaryType()
    row = T.StructField("row", _optional(given.schema["row"].dataType))
    own = [row, *[T.StructField(c, number) for c in COUNTS], T.StructField("groups_sha256", T.StringType())]
    schema = T.StructType([*own, T.StructField("block", number), *[T.StructField(c, blob) for c in ("slots", "times", "pairs", "docs")]])
    made = stage(given.mapInArrow(_encode(a_path, b_path, to_arrow_schema(schema)), schema), "aligned")
    pairs = made.where("pairs is not null").select("block", "pairs", "docs").mapInArrow(_listed, "block long, slot long, pair long, docs long")
    totals = pairs.groupBy("pair").agg(F.sum("docs").alias("total")).withColumn("a", F.shiftright("pair", BITS))
    most = totals.groupBy("a").agg(F.max("total").alias("most"))
    known = totals.join(most, "a").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))
    answers = pairs.select("block", "slot", "pair").join(known, "pair").select("block", "slot", "total", "best")
    texts = made.where("slots is not null").select(*[f.name for f in own], "block", "slots", "times")
    out = T.StructType([*own, T.StructField("n_best", number), T.StructField("count_sum", number)])
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_sums(to_arrow_schema(out)), out)
