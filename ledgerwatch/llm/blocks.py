"""Hashes over byte arrays, and the exchange between blocks of documents and buckets of hashes.

Corpus-wide questions ("which strings occur in two documents?") are asked in two
shuffles: each *block* of documents sends its distinct hashes, sorted, to *buckets*
that own a range of the hash space, and each bucket answers the blocks that asked.
A key that every document holds is one entry per block, so no key makes a task hot.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text of one block, in bytes, and text whose hashes one bucket answers. There are at least three
#: blocks and one bucket per shuffle partition. A block has a message for each bucket it has
#: hashes for, so with more memory for a task both may grow, for fewer messages.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 6 << 20
#: Bytes that one pass of the hash functions looks at.
STEP = 1 << 18
LAST = np.iinfo(np.int64).max

U64 = np.uint64
_random = np.random.default_rng(20240117)
BYTE_CODE = _random.integers(1, 2**63, 256, dtype=U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.cumprod(out, dtype=U64)


POWER = _powers(_BASE, STEP + 4096)
UNPOWER = _powers(_INVERSE, STEP + 4096)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """The finalizer of splitmix64."""
    h = h + U64((seed * 0xA0761D6478BD642F) % 2**64)
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def utf8(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and the offsets of its rows in them. Null is empty."""
    chunks = [c.cast(pa.large_string()) for c in column.chunks]
    array = pa.concat_arrays(chunks) if chunks else pa.array([], pa.large_string())
    if array.null_count:
        array = array.fill_null("")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def ids(column: pa.ChunkedArray) -> np.ndarray:
    """64-bit ids; null counts as larger than every other."""
    return column.cast(pa.int64()).fill_null(LAST).to_numpy().astype(np.int64)


def planes(values: np.ndarray, width: int = 8) -> bytes:
    """Numbers as byte planes, low bytes first: equal high bytes then compress away."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return raw[:, :width].T.tobytes()


def unplanes(data: bytes, width: int, dtype) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view(dtype)


def pack(*parts: bytes) -> bytes:
    sizes = np.array([len(parts), *map(len, parts)], np.int64)
    return sizes.tobytes() + b"".join(parts)


def unpack(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, n, 8)
    ends = 8 * (n + 1) + np.cumsum(sizes)
    return [data[e - s : e] for s, e in zip(sizes.tolist(), ends.tolist())]


def place(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of a hash, rising with it, and 32 further bits of its place in the bucket."""
    # The high 96 bits of hash times buckets, for up to 2**32 buckets.
    x = (h >> U64(32)) * U64(buckets) + (((h & U64(0xFFFFFFFF)) * U64(buckets)) >> U64(32))
    return (x >> U64(32)).astype(np.int64), (x & U64(0xFFFFFFFF)).astype(np.uint32)


def slices(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, end) of the runs in a sorted array."""
    if not len(bucket):
        return []
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[starts[1:], len(bucket)]
    return list(zip(bucket[starts].tolist(), starts.tolist(), ends.tolist()))


def take_slices(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The concatenation of ``data[s : s + n]``."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return data[np.arange(total) + np.repeat(starts - (ends - sizes), sizes)]


def run_values(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The polynomial of each run ``data[start:end]``; runs are in order and do not overlap.

    Powers start anew every ``STEP`` bytes; a longer run is taken alone.
    """
    out, lo = np.zeros(len(start), U64), 0
    while lo < len(start):
        base = start[lo]
        hi = max(int(np.searchsorted(end, base + STEP, "right")), lo + 1)
        part = data[base : end[hi - 1]]
        if len(part) > STEP:
            out[lo] = (BYTE_CODE[part] * _powers(_BASE, len(part))).sum(dtype=U64)
        else:
            total = np.zeros(len(part) + 1, U64)
            np.cumsum(BYTE_CODE[part] * POWER[: len(part)], out=total[1:])
            out[lo:hi] = (total[end[lo:hi] - base] - total[start[lo:hi] - base]) * UNPOWER[start[lo:hi] - base]
        lo = hi
    return out


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted ones, and where."""
    if not len(sorted_keys):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return sorted_keys[at] == keys, at


def counts(spark: SparkSession, docs: DataFrame, text: Column, bucket_bytes: int = BUCKET_BYTES, least: int = 1, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """Numbers of blocks and of buckets, from the bytes of text and the session's partitions.

    However many partitions there are, none of both gets less than ``least`` bytes of text.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    most = -(-max(size, 1) // least) if least > 1 else 3 * parts
    return max(min(3 * parts, most), -(-size // block_bytes)), max(min(parts, most), -(-size // bucket_bytes))


def _release() -> None:
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def frugal(group: Callable) -> Callable:
    """Give a group's memory back to the system after it; a worker else keeps the largest group's."""
    # Spark looks at the number of arguments, so each has a wrapper of its own.
    if len(inspect.signature(group).parameters) == 2:

        @functools.wraps(group)
        def run(key, table):
            out = group(key, table)
            _release()
            return out

    else:

        @functools.wraps(group)
        def run(key, left, right):
            out = group(key, left, right)
            _release()
            return out

    return run


def block_of(n: int, *columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n))


MESSAGE = "bucket long, block long, data binary"


def messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    bucket, block, data = zip(*rows) if rows else ((), (), ())
    return pa.table(
        {"bucket": pa.array(bucket, pa.int64()), "block": pa.array(block, pa.int64()), "data": pa.array(data, pa.binary())}
    )
