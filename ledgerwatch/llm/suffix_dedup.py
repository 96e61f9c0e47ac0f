"""Remove byte strings that an earlier document holds, by merging Burrows-Wheeler transforms.

A string of ``length`` bytes is a *window*. Each window has an *anchor*, the 24-byte
substring with the least hash in it. Neighbouring windows with one anchor form a
*context*. Equal windows have equal anchors, so whatever repeats meets under its
anchor's hash, and anchors that occur in one document need no further look: blocks first send
names of their anchors, some two bytes each, and then the contexts of repeated ones alone.

A window has half of its other bytes before its anchor, or more than half behind it. So a
context shares a window only with contexts that agree with it on one of these two halves;
the bucket knows them by a short hash. Where no other string does, all windows of the
context share its own smallest document. The others, among them all that agree by chance
of the short hash, go to the merge: distinct contexts of a bucket are dealt
to shards, each shard's Burrows-Wheeler transform is built alone, and the transforms
are interleaved by refinement: round t puts the suffixes in order of their first t
symbols with one stable pass over the transforms, without looking at the suffixes.
Suffixes that stay together for the length of a window are a repeated interval, whose
common prefix is the window; its smallest document decides.

Anchors with very many contexts are sent window by window, by hashes of the window, and spread
by these, so that no anchor makes a task hot. Single windows are alike or have nothing in
common, so that nothing of them is left to merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwatch.llm import blocks as B

#: Bytes of an anchor.
ANCHOR = 24
#: Text of a block, text whose anchors one bucket answers, and the least text of a block or bucket, in bytes. A
#: block has a message for each bucket, so that small ones are many and nearly empty.
BLOCK_BYTES, BUCKET_BYTES, LEAST_BYTES = 8 << 20, 24 << 20, 256 << 10
#: Distinct contexts of an anchor, of those that go to the merge, beyond which its windows travel singly.
CROWD = 1024
#: Bits of an anchor's name in its bucket. Anchors that share one by chance are only looked at once more.
NAME_BITS = 25
#: Stretches of a context, shards of a merge, and symbols that are merged at a time (whole anchors only).
STRETCHES, SHARDS = 4, 4
MERGE_SYMBOLS = 1 << 18
_LOW = np.uint64((1 << 19) - 1)
_CODE = np.uint64((1 << 48) - 1)
SINGLE, MANY, CROWDED = 1, 2, 3
#: First byte of messages: repeated names, answers about contexts, merged contexts, single windows.
_REPEATED, _KNOWN, _MERGED, _WINDOWS = b"r", b"k", b"m", b"w"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, values
    while span * 2 <= width:
        out, span = np.minimum(out[:-span], out[span:]), span * 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if span < width else out


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int]]:
    """First windows, and their ends, of pieces of whole rows, or of parts of a row that are cut from its first byte."""
    row = 0
    while row < len(offsets) - 1:
        lo = int(offsets[row])
        row = max(int(np.searchsorted(offsets, lo + B.STEP, "right")) - 1, row + 1)
        last = int(offsets[row]) - length + 1
        yield from ((at, min(at + B.STEP, last)) for at in range(lo, last, B.STEP))


def contexts(data: np.ndarray, offsets: np.ndarray, length: int, halves: bool = False) -> dict[str, np.ndarray]:
    """Contexts of all rows: row, first and last window, anchor place, hashes of anchor and context.

    They follow from the row's own bytes, wherever it is in its block. With ``halves``, also 16 and 15 bits of hashes of the anchor with half of a window's other bytes before
    it, or with more than half behind it; 0 if no window of the context has these.
    """
    anchor = min(ANCHOR, length)
    before = (length - anchor) // 2
    behind = length - anchor - before + 1
    parts: list[tuple] = []
    for lo, hi in _pieces(offsets, length):
        piece = data[lo : hi + length - 1]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(B.BYTE_CODE[piece] * B.POWER[: len(piece)], out=total[1:])
        n = len(piece) - anchor + 1
        grams = B.mix((total[anchor:] - total[:n]) * B.UNPOWER[:n])
        least = sliding_min((grams & ~_LOW) | np.arange(n, dtype=np.uint64), length - anchor + 1)
        first, last = np.searchsorted(offsets, [lo, hi - 1], "right") - 1
        held = np.diff(np.clip(offsets[first : last + 2], lo, hi))
        ends = np.repeat(offsets[first + 1 : last + 2], held)
        valid = np.arange(lo, hi) + length <= ends
        other = least[1:] != least[:-1]
        begin = np.flatnonzero(valid & np.r_[True, other | ~valid[:-1]])
        end = np.flatnonzero(valid & np.r_[other | ~valid[1:], True])
        row = np.repeat(np.arange(first, last + 1), held)[begin]
        place = (least[begin] & _LOW).astype(np.int64)
        whole = (total[end + length] - total[begin]) * B.UNPOWER[begin]
        code = B.mix(whole, 1) ^ B.mix((end - begin).astype(np.uint64), 2)
        part = (row, lo + begin, lo + end, lo + place, grams[place], code)
        if halves:
            for has, first_byte, size, seed, bits in ((place - begin >= before, place - before, anchor + before, 5, 16), (place - end < before, place, anchor + behind, 6, 15)):
                at = first_byte[has]
                half = np.zeros(len(place), np.uint64)
                half[has] = B.mix((total[at + size] - total[at]) * B.UNPOWER[at], seed) % np.uint64(2**bits - 1) + np.uint64(1)
                part += (half,)
        parts.append(part)
    names = ("row", "begin", "end", "anchor", "gram", "code") + ("before", "behind") * halves
    kinds = (np.int64,) * 4 + (np.uint64,) * (len(names) - 4)
    return {
        k: np.concatenate([p[i] for p in parts]).astype(t) if parts else np.zeros(0, t)
        for i, (k, t) in enumerate(zip(names, kinds))
    }


def window_code(windows: np.ndarray) -> np.ndarray:
    """The context hash of single windows, given as rows of bytes."""
    whole = (B.BYTE_CODE[windows] * B.POWER[: windows.shape[1]]).sum(axis=1, dtype=np.uint64)
    return B.mix(whole, 1) ^ B.mix(np.zeros(len(windows), np.uint64), 2)


def _route(gram: np.ndarray) -> np.ndarray:
    """A hash of the anchor's hash: that one is the least of its window, so that anchors crowd at the low end."""
    return B.mix(gram, 4)


def _slot(gram: np.ndarray, buckets: int) -> np.ndarray:
    bucket, rest = B.place(_route(gram), buckets)
    return (bucket.astype(np.uint64) << np.uint64(32)) | rest.astype(np.uint64)


def _planes(*columns: tuple[np.ndarray, int]) -> np.ndarray:
    """Numbers as byte planes, a row for each plane, low bytes first; any range of places is then a message."""
    return np.concatenate([np.ascontiguousarray(v).view(np.uint8).reshape(len(v), v.itemsize)[:, :width].T for v, width in columns])


def _numbers(planes: np.ndarray, dtype) -> np.ndarray:
    out = np.zeros((planes.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view(dtype)


def _joined(messages: list[bytes], height: int) -> tuple[np.ndarray, np.ndarray]:
    """The planes of all messages side by side, and how many places each message has."""
    parts = [np.frombuffer(m, np.uint8).reshape(height, -1) for m in messages]
    return np.concatenate(parts, axis=1) if parts else np.zeros((height, 0), np.uint8), np.array([p.shape[1] for p in parts], np.int64)


def _names(slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the anchors' names (bucket and further bits), where each begins in it, and the names."""
    names = slot >> np.uint64(32 - NAME_BITS)
    order = np.argsort(names)
    names = names[order]
    at = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    return order, at, names[at]


def _anchors(length: int, buckets: int):
    """Per block: the names of its anchors as steps from one to the next, and whether two documents hold it."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        data, offsets = B.utf8(table["text"])
        c = contexts(data, offsets, length)
        if not len(c["row"]):
            return B.messages([])
        order, at, names = _names(_slot(c["gram"], buckets))
        doc = B.ids(table["id"])[c["row"]][order]
        two = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
        bucket, name = (names >> np.uint64(NAME_BITS)).astype(np.int64), (names & np.uint64(2**NAME_BITS - 1)).astype(np.uint32)
        step = np.diff(name, prepend=np.uint32(0))
        step[np.flatnonzero(np.diff(bucket)) + 1] = name[np.flatnonzero(np.diff(bucket)) + 1]
        planes = _planes(((step << np.uint32(1)) | two, 4))
        return B.messages([(b, key[0].as_py(), planes[:, i:j].tobytes()) for b, i, j in B.slices(bucket)])

    return run


@B.frugal
def _repeated(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per bucket: tell each block by a bit which of its anchors' names occur twice."""
    seen = np.zeros(2**NAME_BITS, np.uint8)
    sent = [_numbers(np.frombuffer(d, np.uint8).reshape(4, -1), np.uint32) for d in table["data"].to_pylist()]
    for steps in sent:
        names = np.cumsum(steps >> 1)
        seen[names] = np.minimum(seen[names] + 1 + (steps & 1).astype(np.uint8), 2)
    rows = []
    for b, steps in zip(table["block"].to_pylist(), sent):
        twice = seen[np.cumsum(steps >> 1)] > 1
        if twice.any():
            rows.append((key[0].as_py(), b, _REPEATED + np.packbits(twice).tobytes()))
    return B.messages(rows)


def _entries(c: dict, slot: np.ndarray, answers: pa.Table | None) -> tuple[np.ndarray, np.ndarray]:
    """Contexts that a block sends, by anchor and hash, and where each distinct one begins: of repeated anchors if it has been told.

    They follow from the set of the block's contexts, so that answers need not name them.
    """
    some = np.arange(len(slot))
    repeated = _messages(answers, _REPEATED) if answers else []
    if repeated:
        order, at, names = _names(slot)
        twice, place = np.zeros(len(names), bool), {b: (i, j) for b, i, j in B.slices((names >> np.uint64(NAME_BITS)).astype(np.int64))}
        for bucket, bits in repeated:
            i, j = place[bucket]
            twice[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i)
        some = order[np.repeat(twice, np.diff(np.r_[at, len(order)]))]
    code = c["code"][some] & _CODE
    order = np.lexsort((code, slot[some]))
    some, code = some[order], code[order]
    return some, np.flatnonzero(np.r_[True, (slot[some][1:] != slot[some][:-1]) | (code[1:] != code[:-1])][: len(some)])


def _messages(table: pa.Table, kind: bytes) -> list[tuple[int, bytes]]:
    """Bucket and content of the messages of a kind."""
    return [(b, d[1:]) for b, d in zip(table["bucket"].to_pylist(), table["data"].to_pylist()) if d[:1] == kind]


def _about(block: int, table: pa.Table, length: int, buckets: int, answers: pa.Table | None) -> pa.Table:
    """Messages with each context's anchor, smallest document and halves, and whether it is in two documents."""
    c = contexts(*B.utf8(table["text"]), length, halves=True)
    slot = _slot(c["gram"], buckets)
    order, at = _entries(c, slot, answers)
    if not len(order):
        return B.messages([])
    doc, one = B.ids(table["id"])[c["row"][order]], order[at]
    low, high = np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)
    halves = (c["before"][one] << np.uint64(16)) | (c["behind"][one] << np.uint64(1)) | (low != high)
    planes = _planes((slot[one], 4), (c["code"][one], 6), (low, 8), (halves, 4))
    return B.messages([(b, block, planes[:, i:j].tobytes()) for b, i, j in B.slices((slot[one] >> np.uint64(32)).astype(np.int64))])


def _sketch(length: int, buckets: int):
    """For a single block: all its contexts."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return _about(key[0].as_py(), table, length, buckets, None)

    return run


def _sketch_repeated(length: int, buckets: int):
    """Per block: its contexts of anchors that :func:`_repeated` has told of."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table, repeated: pa.Table) -> pa.Table:
        return _about(key[0].as_py(), table, length, buckets, repeated) if len(table) and len(repeated) else B.messages([])

    return run


def _several(group: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Which of these distinct contexts agree with another one of their anchor on a half that they have."""
    have = np.flatnonzero(half)
    _, place, count = np.unique((group[have].astype(np.uint64) << np.uint64(16)) | half[have], return_inverse=True, return_counts=True)
    out = np.zeros(len(group), bool)
    out[have] = count[place] > 1
    return out


@B.frugal
def _resolve(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Per bucket: tell each block which of its contexts may share windows with another document."""
    planes, sizes = _joined(table["data"].to_pylist(), 22)
    rest, low, flags = _numbers(planes[:4], np.uint32), _numbers(planes[10:18], np.int64), _numbers(planes[18:], np.uint32)
    order = np.argsort(rest, kind="stable")
    at = np.flatnonzero(np.r_[True, rest[order][1:] != rest[order][:-1]])
    least, most = np.minimum.reduceat(low[order], at), np.maximum.reduceat(low[order], at)
    shared = (least != most) | (np.bitwise_or.reduceat(flags[order] & 1, at) > 0)
    # From here on only the contexts of anchors that are in two documents.
    some = order[np.repeat(shared, np.diff(np.r_[at, len(rest)]))]
    if not len(some):
        return B.messages([])
    code = _numbers(planes[4:10, some], np.uint64)
    inside = np.lexsort((code, rest[some]))
    some, code = some[inside], code[inside]
    anew = np.r_[True, rest[some][1:] != rest[some][:-1]]
    at = np.flatnonzero(anew | np.r_[True, code[1:] != code[:-1]])
    group = np.cumsum(anew)[at] - 1
    least, most = np.minimum.reduceat(low[some], at), np.maximum.reduceat(low[some], at)
    twice = (least != most) | (np.bitwise_or.reduceat(flags[some] & 1, at) > 0)
    halves = flags[some[at]].astype(np.uint64)
    many = _several(group, halves >> np.uint64(16)) | _several(group, (halves >> np.uint64(1)) & np.uint64(2**15 - 1))
    crowded = np.bincount(group, many) > CROWD
    kind = np.where(many, np.where(crowded[group], CROWDED, MANY), np.where(twice, SINGLE, 0)).astype(np.uint8)
    times = np.diff(np.r_[at, len(some)])
    told, known = np.repeat(kind, times), np.repeat(np.where(kind == SINGLE, least, 0), times)
    told[(told == SINGLE) & (low[some] == known) & (flags[some] % 2 == 0)] = 0
    # Back to the order of the messages.
    kinds, leasts = np.zeros(len(rest), np.uint8), np.zeros(len(rest), np.int64)
    kinds[some], leasts[some] = told, known
    one = np.flatnonzero(kinds == SINGLE)
    planes, ends = _planes((leasts[one], 8)), np.cumsum(sizes)
    cuts = np.searchsorted(one, ends).tolist()
    rows = []
    for b, i, j, u, v in zip(table["block"].to_pylist(), (ends - sizes).tolist(), ends.tolist(), [0, *cuts], cuts):
        if kinds[i:j].any():
            rows.append((key[0].as_py(), b, _KNOWN + kinds[i:j].tobytes() + planes[:, u:v].tobytes()))
    return B.messages(rows)


def _told(c: dict, answers: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets' answers of :func:`_resolve` about each context of a block: its kind and, if it is ``SINGLE``, its document."""
    kind, least = np.zeros(len(c["row"]), np.uint8), np.zeros(len(c["row"]), np.int64)
    known = _messages(answers, _KNOWN)
    if known:
        slot = _slot(c["gram"], buckets)
        order, at = _entries(c, slot, answers)
        place = {b: (i, j) for b, i, j in B.slices((slot[order[at]] >> np.uint64(32)).astype(np.int64))}
        kinds, leasts = np.zeros(len(at), np.uint8), np.zeros(len(at), np.int64)
        for bucket, data in known:
            i, j = place[bucket]
            kinds[i:j] = np.frombuffer(data, np.uint8, j - i)
            leasts[i + np.flatnonzero(kinds[i:j] == SINGLE)] = _numbers(np.frombuffer(data, np.uint8, offset=j - i).reshape(8, -1), np.int64)
        times = np.diff(np.r_[at, len(order)])
        kind[order], least[order] = np.repeat(kinds, times), np.repeat(leasts, times)
    return kind, least


def _window_starts(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First bytes of the windows of contexts that begin there and have so many."""
    return np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _crowded_windows(data: np.ndarray, c: dict, pick: np.ndarray, length: int) -> Iterator[tuple]:
    """Windows of crowded contexts: which context, first byte, hash; a bounded number at a time."""
    for lo in range(0, len(pick), 2048):
        part = pick[lo : lo + 2048]
        n = c["end"][part] - c["begin"][part] + 1
        which = np.repeat(part, n)
        start = _window_starts(c["begin"][part], n)
        yield which, start, window_code(data[start[:, None] + np.arange(length)])


def _window_messages(block: int, code: np.ndarray, gram: np.ndarray, doc: np.ndarray, buckets: int) -> list[tuple[int, int, bytes]]:
    """Distinct windows with their smallest document, and whether the block has another one with them."""
    route = B.mix(code, 3)
    order = np.lexsort((doc, gram, route))
    at = np.flatnonzero(np.r_[True, (route[order][1:] != route[order][:-1]) | (gram[order][1:] != gram[order][:-1])][: len(order)])
    if not len(at):
        return []
    two = np.maximum.reduceat(doc[order], at) != doc[order][at]
    keep = order[at]
    planes = _planes((code[keep], 8), (gram[keep], 4), (doc[keep], 8), (two, 1))
    return [(b, block, _WINDOWS + planes[:, i:j].tobytes()) for b, i, j in B.slices(B.place(route[keep], buckets)[0])]


def _alike(key: int, block: list[int], messages: list[bytes]) -> list[tuple[int, int, bytes]]:
    """Per bucket: the smallest document of each single window, for blocks that do not hold it alone."""
    planes, sizes = _joined([m[1:] for m in messages], 21)
    code, gram, doc = _numbers(planes[:8], np.uint64), _numbers(planes[8:12], np.uint32), _numbers(planes[12:20], np.int64)
    order = np.lexsort((gram, code))
    new = np.r_[True, (code[order][1:] != code[order][:-1]) | (gram[order][1:] != gram[order][:-1])]
    at = np.flatnonzero(new)
    least = np.empty_like(doc)
    least[order] = np.repeat(np.minimum.reduceat(doc[order], at), np.diff(np.r_[at, len(doc)]))
    told = np.flatnonzero((least < doc) | (planes[20] > 0))
    planes = _planes((code[told], 8), (least[told], 8))
    ends = np.searchsorted(told, np.cumsum(sizes)).tolist()
    return [(key, b, _WINDOWS + planes[:, i:j].tobytes()) for b, i, j in zip(block, [0, *ends], ends) if j > i]


def _contexts_to_merge(length: int, buckets: int):
    """Per block: the distinct contexts that may share windows with others, with their smallest document."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets = B.utf8(docs["text"])
        ids = B.ids(docs["id"])
        if not len(answers):
            return B.messages([])
        c = contexts(data, offsets, length)
        kind, _ = _told(c, answers, buckets)
        doc = ids[c["row"]]
        pick = np.flatnonzero(kind == MANY)
        gram, code, start, size = c["gram"][pick], c["code"][pick], c["begin"][pick], c["end"][pick] - c["begin"][pick] + length
        crowd = [(h, c["gram"][which], doc[which]) for which, _, h in _crowded_windows(data, c, np.flatnonzero(kind == CROWDED), length)]
        rows = _window_messages(key[0].as_py(), *map(np.concatenate, zip(*crowd)), buckets) if crowd else []
        route, place, doc = _route(gram), c["anchor"][pick] - start, doc[pick]
        order = np.lexsort((doc, code, gram, route))
        keep = order[np.r_[True, (code[order][1:] != code[order][:-1]) | (gram[order][1:] != gram[order][:-1])]] if len(order) else order
        size = size[keep]
        planes, text = _planes((size, 2), (place[keep], 2), (doc[keep], 8)), B.take_slices(data, start[keep], size)
        ends = np.cumsum(size)
        for b, i, j in B.slices(B.place(route[keep], buckets)[0]):
            rows.append((b, key[0].as_py(), _MERGED + B.pack(planes[:, i:j].tobytes(), text[ends[i] - size[i] : ends[j - 1]].tobytes())))
        return B.messages(rows)

    return run


def shard_transform(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and Burrows-Wheeler transform of strings that end in 0, are distinct and in order.

    ``depth`` is at least the longest string with its end. Suffixes that are equal up
    to the end follow the order of their strings, as the cyclic rotations do.
    """
    padded = np.concatenate([symbols, np.zeros(depth, np.uint16)])
    rows = sliding_window_view(padded, depth)[: len(symbols)].astype(">u2")
    over = np.cumsum(rows == 0, axis=1, dtype=np.uint16) > 0
    rows[over] = 0
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{2 * depth}").reshape(-1), kind="stable")
    before = np.empty(len(symbols), np.uint16)
    before[1:] = symbols[:-1]
    before[0] = 0
    return order, before[order]


def merge_transforms(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave transforms by their suffixes' first ``rounds`` symbols.

    Returns, in merged order, the place of each suffix in the concatenated shard orders,
    and whether its first ``rounds`` symbols differ from those of the suffix before it.
    """
    sizes = [len(t) for t in transforms]
    symbols = np.concatenate(transforms)
    shard = np.repeat(np.arange(len(sizes), dtype=np.uint8), sizes)
    place = np.arange(len(symbols), dtype=np.int32)
    prefix = np.zeros(len(symbols), np.int32)
    fresh = np.zeros(len(symbols), bool)
    for _ in range(rounds):
        lead = symbols[place]
        order = np.argsort(lead, kind="stable")
        shard, prefix, lead = shard[order], prefix[order], lead[order]
        fresh[:1] = True
        fresh[1:] = (lead[1:] != lead[:-1]) | (prefix[1:] != prefix[:-1])
        prefix = np.cumsum(fresh, dtype=np.int32)
        place[np.argsort(shard, kind="stable")] = np.arange(len(symbols), dtype=np.int32)
    return place, fresh


def smallest_documents(
    text: np.ndarray, size: np.ndarray, gram: np.ndarray, place: np.ndarray, doc: np.ndarray, length: int, anchor: int
) -> np.ndarray:
    """For each window of each context, in order, the smallest document that has the window.

    The contexts are distinct and come in order of their anchors, which have ``anchor``
    bytes. An anchor is one symbol, since all its bytes are known to agree.
    """
    out = np.full(int((size - length + 1).sum()), B.LAST)
    starts, firsts = np.cumsum(size) - size, np.cumsum(size - length + 1) - (size - length + 1)
    group = np.cumsum(np.r_[True, gram[1:] != gram[:-1]]) - 1 if len(gram) else np.zeros(0, np.int64)
    short = size - anchor + 2
    cuts, lo = [], 0
    filled = np.cumsum(short)
    while lo < len(size):
        hi = int(np.searchsorted(filled, filled[lo] + MERGE_SYMBOLS, "right"))
        hi = int(np.searchsorted(group, group[min(hi, len(group) - 1)], "left")) if hi < len(group) else len(group)
        if hi <= lo:  # one anchor fills it alone
            hi = int(np.searchsorted(group, group[lo], "right"))
        hi = min(hi, int(np.searchsorted(group, group[lo] + 60_000, "left")))
        cuts.append((lo, hi))
        lo = hi
    for lo, hi in cuts:
        n, a = size[lo:hi], place[lo:hi]
        total = int((n - anchor + 2).sum())
        ends = np.cumsum(n - anchor + 2)
        begin = ends - (n - anchor + 2)
        symbols = np.zeros(total, np.uint16)
        left = np.arange(int(a.sum())) - np.repeat(np.cumsum(a) - a, a)
        symbols[np.repeat(begin, a) + left] = text[np.repeat(starts[lo:hi], a) + left].astype(np.uint16) + 1
        symbols[begin + a] = (group[lo:hi] - group[lo] + 257).astype(np.uint16)
        r = n - a - anchor
        right = np.arange(int(r.sum())) - np.repeat(np.cumsum(r) - r, r)
        symbols[np.repeat(begin + a + 1, r) + right] = text[np.repeat(starts[lo:hi] + a + anchor, r) + right].astype(np.uint16) + 1
        depth = int((n - anchor + 2).max())
        # Strings in order, so that ends of strings follow the order of the rotations.
        matrix = np.zeros((hi - lo, depth), ">u2")
        matrix[np.repeat(np.arange(hi - lo), n - anchor + 2), np.arange(total) - np.repeat(begin, n - anchor + 2)] = symbols
        ranked = np.argsort(matrix.view(f"S{2 * depth}").reshape(-1), kind="stable")
        transforms, owners = [], []
        for s in range(SHARDS):
            mine = ranked[s::SHARDS]
            if not len(mine):
                continue
            lens = (n - anchor + 2)[mine]
            part = B.take_slices(symbols, begin[mine], lens)
            order, transform = shard_transform(part, depth)
            transforms.append(transform)
            whose = np.repeat(mine, lens)
            inside = np.arange(len(part)) - np.repeat(np.cumsum(lens) - lens, lens)
            owners.append(np.stack([whose[order], inside[order]]))
        merged, fresh = merge_transforms(transforms, length - anchor + 1)
        whose, inside = np.concatenate(owners, axis=1)[:, merged]
        windows = inside < (n - length + 1)[whose]
        value = np.where(windows, doc[lo:hi][whose], B.LAST)
        at = np.flatnonzero(fresh)
        least = np.repeat(np.minimum.reduceat(value, at), np.diff(np.r_[at, len(value)]))
        out[(firsts[lo:hi][whose] + inside)[windows]] = least[windows]
    return out


def _stretches(length: int) -> list[tuple[int, int]]:
    """Ranges of the number of bytes that a window has before its anchor, at most ``STRETCHES`` of about one size."""
    beside = length - min(ANCHOR, length)
    cuts = np.linspace(0, beside + 1, min(STRETCHES, beside + 1) + 1).astype(int).tolist()
    return [(lo, hi - 1) for lo, hi in zip(cuts[:-1], cuts[1:])]


def least_documents(text: np.ndarray, size: np.ndarray, place: np.ndarray, doc: np.ndarray, length: int) -> np.ndarray:
    """For each window of each context, in order, the smallest document that has the window.

    Contexts are cut into stretches: windows with about as many bytes before their anchor all hold
    the anchor with some bytes around it, which is the stretch's own, longer anchor. So only
    distinct stretches that share it are merged, in fewer rounds.
    """
    starts, windows = np.cumsum(size) - size, size - length + 1
    firsts = np.cumsum(windows) - windows
    out = np.full(int(windows.sum()), B.LAST)
    for before, most in _stretches(length):
        anchor = length - (most - before)
        first, last = np.maximum(place - most, 0), np.minimum(place - before, windows - 1)
        some = np.flatnonzero(first <= last)
        at, n = starts[some] + first[some], (last - first)[some] + 1
        where = starts[some] + place[some] - before
        gram = B.mix(B.run_values(text, where, where + anchor), 9)
        code = B.mix(B.run_values(text, at, at + n + length - 1), 1) ^ B.mix((n - 1).astype(np.uint64), 2)
        order = np.lexsort((doc[some], code, gram))
        anew = np.r_[True, gram[order][1:] != gram[order][:-1]][: len(order)]
        new = anew | np.r_[True, code[order][1:] != code[order][:-1]][: len(order)]
        keep = order[new]
        least = np.repeat(doc[some[keep]], n[keep])
        several = np.bincount(np.cumsum(anew)[new] - 1) > 1 if len(order) else np.zeros(0, bool)
        several = several[np.cumsum(anew)[new] - 1]
        k = keep[several]
        bytes_of = n[k] + length - 1
        least[np.repeat(several, n[keep])] = smallest_documents(
            B.take_slices(text, at[k], bytes_of), bytes_of, gram[k], where[k] - at[k], doc[some[k]], length, anchor
        )
        unique = np.empty(len(order), np.int64)
        unique[order] = np.cumsum(new) - 1
        held = np.cumsum(n[keep]) - n[keep]
        out[_window_starts(firsts[some] + first[some], n)] = least[_window_starts(held[unique], n)]
    return out


def _merge(length: int):
    """Per bucket: merge the contexts, and tell each block the documents of its windows."""

    @B.frugal
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sent = list(zip(table["block"].to_pylist(), table["data"].to_pylist()))
        single = [(b, d) for b, d in sent if d[:1] == _WINDOWS]
        rows = _alike(key[0].as_py(), *map(list, zip(*single))) if single else []
        sent = [(b, B.unpack(d[1:])) for b, d in sent if d[:1] == _MERGED]
        if not sent:
            return B.messages(rows)
        parts = [p for _, p in sent]
        planes, counts = _joined([p[0] for p in parts], 12)
        size, place, doc = (_numbers(planes[i:j], np.int64) for i, j in ((0, 2), (2, 4), (4, 12)))
        text = np.concatenate([np.frombuffer(p[1], np.uint8) for p in parts])
        del parts, planes
        starts = np.cumsum(size) - size
        gram = B.mix(B.run_values(text, starts + place, starts + place + min(ANCHOR, length)))
        code = B.mix(B.run_values(text, starts, starts + size), 1) ^ B.mix((size - length).astype(np.uint64), 2)
        order = np.lexsort((doc, code, gram))
        new = np.r_[True, (code[order][1:] != code[order][:-1]) | (gram[order][1:] != gram[order][:-1])]
        keep = order[new]
        unique = np.empty(len(order), np.int64)
        unique[order] = np.cumsum(new) - 1
        windows = (size - length + 1)[keep]
        least = least_documents(B.take_slices(text, starts[keep], size[keep]), size[keep], place[keep], doc[keep], length)
        first = np.cumsum(windows) - windows
        windows = windows[unique]
        contexts_of = _planes((code, 8), (windows, 2))
        values = _planes((B.take_slices(least, first[unique], windows), 8))
        ends, i = np.cumsum(windows), 0
        for (b, _), j in zip(sent, np.cumsum(counts).tolist()):
            rows.append((key[0].as_py(), b, _MERGED + B.pack(contexts_of[:, i:j].tobytes(), values[:, ends[i] - windows[i] : ends[j - 1]].tobytes())))
            i = j
        return B.messages(rows)

    return run


def _spans(data, offsets, ids, answers: pa.Table, length: int, buckets: int) -> np.ndarray:
    """Which bytes of a block an earlier document holds."""
    if not len(answers):
        return np.zeros(len(data), bool)
    c = contexts(data, offsets, length)
    kind, least = _told(c, answers, buckets)
    doc = ids[c["row"]]
    pick = np.flatnonzero((kind == SINGLE) & (least < doc))
    begins, ends = [c["begin"][pick]], [c["end"][pick] + length]
    merged = [B.unpack(d) for _, d in _messages(answers, _MERGED)]
    if merged:
        planes, _ = _joined([m[0] for m in merged], 10)
        code, windows = _numbers(planes[:8], np.uint64), _numbers(planes[8:], np.int64)
        values = _numbers(_joined([m[1] for m in merged], 8)[0], np.int64)
        order = np.argsort(code)
        code, first = code[order], (np.cumsum(windows) - windows)[order]
        pick = np.flatnonzero(kind == MANY)
        known, at = B.find(code, c["code"][pick])
        pick, at = pick[known], at[known]
        n = c["end"][pick] - c["begin"][pick] + 1
        older = values[_window_starts(first[at], n)] < np.repeat(doc[pick], n)
        begins.append(_window_starts(c["begin"][pick], n)[older])
        ends.append(begins[-1] + length)
    single = _messages(answers, _WINDOWS)
    if single:
        planes, _ = _joined([d for _, d in single], 16)
        order = np.argsort(_numbers(planes[:8], np.uint64))
        code, values = _numbers(planes[:8], np.uint64)[order], _numbers(planes[8:], np.int64)[order]
        for which, start, hashes in _crowded_windows(data, c, np.flatnonzero(kind == CROWDED), length):
            known, at = B.find(code, hashes)
            older = known & (values[at] < doc[which])
            begins.append(start[older])
            ends.append(start[older] + length)
    edge = np.bincount(np.concatenate(begins), minlength=len(data) + 1)
    edge -= np.bincount(np.concatenate(ends), minlength=len(data) + 1)
    return np.cumsum(edge[:-1]) > 0


def cut_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """``gone`` widened to all bytes of each UTF-8 character that it cuts through."""
    character = np.cumsum((text & 0xC0) != 0x80)
    cut = np.zeros(int(character[-1]) + 1, bool)
    cut[character[gone]] = True
    return cut[character]


def _remove(length: int, buckets: int, out: pa.Schema, characters: bool):
    @B.frugal
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets = B.utf8(docs["text"])
        gone = _spans(data, offsets, B.ids(docs["id"]), answers, length, buckets)
        spans, kept = [], []
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if not gone[lo:hi].any():
                spans.append([])
                kept.append(data[lo:hi].tobytes())
                continue
            edges = np.flatnonzero(np.diff(np.r_[False, gone[lo:hi], False])).reshape(-1, 2)
            spans.append([{"begin": b, "end": e} for b, e in edges.tolist()])
            left = ~(cut_characters(data[lo:hi], gone[lo:hi]) if characters else gone[lo:hi])
            kept.append(data[lo:hi][left].tobytes())
        columns = [docs["row"].combine_chunks().cast(out.field("row").type), pa.array(np.diff(offsets)), pa.array(spans, out.field("spans").type), pa.array(kept, pa.binary())]
        return pa.Table.from_arrays(columns, schema=out)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, characters: bool = False) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, with what earlier documents do not hold.

    ``n_bytes``: bytes of the UTF-8 text; ``spans``: removed runs ``[begin, end)``;
    ``kept``: the remaining bytes, with ``characters`` without what is left of a character
    that a span cuts through. A byte goes if a string of ``length`` bytes over it
    also starts in a document with a smaller id. Null texts are empty; a null id counts as
    larger than all others; rows with equal ids never remove from each other, so repeated
    rows give equal results. Extra columns ride along in ``row``. No rows give no rows.
    """
    spark = docs.sparkSession
    text: Column = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    n, buckets = B.counts(spark, docs, text, BUCKET_BYTES, LEAST_BYTES, BLOCK_BYTES)
    blocks = docs.select(
        B.block_of(n, docs[id_col], text).alias("block"),
        docs[id_col].cast("long").alias("id"),
        text.alias("text"),
        F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row"),
    )
    # All steps read the blocks alike, so their shuffle is one.
    if n == 1:
        asked = blocks.groupBy("block").applyInArrow(_sketch(length, buckets), B.MESSAGE)
        known = asked.groupBy("bucket").applyInArrow(_resolve, B.MESSAGE)
    else:
        repeated = blocks.groupBy("block").applyInArrow(_anchors(length, buckets), B.MESSAGE).groupBy("bucket").applyInArrow(_repeated, B.MESSAGE)
        asked = blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_sketch_repeated(length, buckets), B.MESSAGE)
        known = asked.groupBy("bucket").applyInArrow(_resolve, B.MESSAGE).unionByName(repeated)
    to_merge = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_contexts_to_merge(length, buckets), B.MESSAGE)
    merged = to_merge.groupBy("bucket").applyInArrow(_merge(length), B.MESSAGE)
    row = blocks.schema["row"].dataType
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([T.StructField("row", row), T.StructField("n_bytes", T.LongType()), T.StructField("spans", span), T.StructField("kept", T.BinaryType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    return blocks.groupBy("block").cogroup(known.unionByName(merged).groupBy("block")).applyInArrow(
        _remove(length, buckets, to_arrow_schema(schema), characters), schema
    )
