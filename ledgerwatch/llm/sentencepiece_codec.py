"""SentencePiece encoding with byte spans, and decoding.

A text is normalised by the longest prefixes of the model's compiled character map, with
the source byte of every normalised byte on record. Pieces are taken in order, so their
lengths sum to places in the normalised text, and these lead back to the original bytes.

No merge crosses a place where no piece of the vocabulary has its two neighbours side by
side. Before each run of word marks that holds for models whose pieces have the mark in
front only. There, words are encoded once per task and remembered; other models, and
models with a character map, encode whole texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerwatch.llm import blocks as B

MARK = "▁"
#: Words that a task remembers before it starts anew. Results do not depend on it.
REMEMBERED = 400_000
#: Text that is encoded at a time.
BATCH_BYTES = 1 << 20
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class CharacterMap:
    """The double-array trie of a compiled character map: longest prefixes and what replaces them."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4 : 4 + size], np.uint32).tolist()
        self.strings = blob[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length of the longest key at ``at``, and its replacement; (0, b"") if there is none."""
        units, found = self.units, (0, b"")
        if not units:
            return found
        node = (units[0] >> 10) << ((units[0] & 0x200) >> 6)
        for i in range(at, len(data)):
            node ^= data[i]
            if node >= len(units) or units[node] & 0x800000FF != data[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit >> 8 & 1:
                begin = units[node] & 0x7FFFFFFF
                found = (i + 1 - at, self.strings[begin : self.strings.index(b"\0", begin)])
        return found


def normalise(text: str, model) -> tuple[bytes, list[int]]:
    """Normalised bytes, and for each and for their end the source byte it comes from."""
    spec = model.normalizer_spec
    data, trie = text.encode(), character_map(spec.precompiled_charsmap)
    space = MARK.encode() if spec.escape_whitespaces else b" "
    parts: list[tuple[bytes, int, int]] = []
    at = 0
    while at < len(data):
        size, new = trie.longest(data, at)
        if not size:
            lead = data[at]
            size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            new = data[at : at + size]
        parts.append((new, at, at + size))
        at += size
    if spec.remove_extra_whitespaces:
        while parts and parts[0][0].strip(b" ") == b"":
            parts.pop(0)
        while parts and parts[-1][0].strip(b" ") == b"":
            parts.pop()
    if not parts:
        return b"", [0]
    out, source = bytearray(), []
    if spec.add_dummy_prefix:
        out += space
        source += [parts[0][1]] * len(space)
    gap = False
    for new, begin, end in parts:
        if spec.remove_extra_whitespaces and gap:
            new = new.lstrip(b" ")
        for k in range(len(new)):
            # Bytes that were copied keep their own place, replaced ones their key's.
            place = begin + k if new == data[begin:end] else begin
            if new[k] == 0x20:
                out += space
                source += [place] * len(space)
            else:
                out.append(new[k])
                source.append(place)
        if new:
            gap = new.endswith(b" ")
    return bytes(out), [*source, parts[-1][2]]


@lru_cache(maxsize=2)
def character_map(blob: bytes) -> CharacterMap:
    return CharacterMap(blob)


class Codec:
    """A model with its piece lengths, and the words it has met."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            blob = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.model = sentencepiece_model_pb2.ModelProto()
        self.model.ParseFromString(blob)
        spec, kinds = self.model.normalizer_spec, self.model.SentencePiece.Type
        self.size = np.array(
            [1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in self.model.pieces], np.int64
        )
        inner = any(MARK in p.piece.lstrip(MARK) for p in self.model.pieces)
        own = any(p.type == kinds.USER_DEFINED for p in self.model.pieces)
        self.by_word = (
            not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces
            and not spec.remove_extra_whitespaces and self.model.trainer_spec.byte_fallback and not inner and not own
        )
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.ids, self.starts = array("i"), array("q", [0])

    def _meet(self, words: list[str]) -> None:
        new = list(dict.fromkeys(w for w in words if w not in self.places))
        # The library puts a mark before what it is given, so a word is given without its first.
        for word, ids in zip(new, self.library.encode([w[1:].replace(MARK, " ") for w in new], num_threads=1)):
            self.places[word] = len(self.starts) - 1
            self.ids.extend(ids if len(word) > 1 else [self.library.piece_to_id(MARK)])
            self.starts.append(len(self.ids))

    def encode(self, texts: list[str], data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids of all texts, first and end byte of each id in its text, and ids per text."""
        if not self.by_word:
            return self._encode_whole(texts)
        if len(self.places) > REMEMBERED:
            self.forget()
        words, counts = [], []
        for text in texts:
            found = _WORD.findall(MARK + text.replace(" ", MARK)) if text else []
            words += found
            counts.append(len(found))
        places = list(map(self.places.get, words))
        if None in places:
            self._meet(words)
            places = list(map(self.places.get, words))
        at = np.array(places, np.int64)
        starts = np.array(self.starts, np.int64)
        sizes = (starts[1:] - starts[:-1])[at]
        ids = B.take_slices(np.array(self.ids, np.int32), starts[at], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(counts)] if counts else np.zeros(0, np.int64)
        weight = 1 + 2 * (data == 0x20).astype(np.int64)
        weight[offsets[:-1][np.diff(offsets) > 0]] += len(MARK.encode())
        stop = np.searchsorted(np.cumsum(weight), np.cumsum(self.size[ids]), "right")
        n = np.diff(np.r_[0, ends])
        base = np.repeat(offsets[:-1], n)
        begin = np.r_[0, stop[:-1]] if len(stop) else stop
        return ids, np.maximum(begin - base, 0).astype(np.int32), (stop - base).astype(np.int32), n

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, ...]:
        ids, begin, end, n = [], [], [], []
        for text in texts:
            pieces = self.library.encode(text, out_type="immutable_proto").pieces
            _, source = normalise(text, self.model)
            at = 0
            for piece in pieces:
                ids.append(piece.id)
                begin.append(source[min(at, len(source) - 1)])
                # An unknown piece has the length of what it stands for.
                at += 1 if self.library.is_byte(piece.id) else len(piece.piece.encode())
                end.append(source[min(at, len(source) - 1)])
            n.append(len(pieces))
        return np.array(ids, np.int32), np.array(begin, np.int32), np.array(end, np.int32), np.array(n, np.int64)


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode(path: str, out: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data, offsets = B.utf8(table["text"])
            lo = 0
            while lo < len(table):
                hi = max(int(np.searchsorted(offsets, offsets[lo] + BATCH_BYTES, "right")) - 1, lo + 1)
                part = table.slice(lo, hi - lo)
                texts = [t or "" for t in part["text"].to_pylist()]
                ids, begin, end, n = own.encode(texts, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                cuts = np.r_[0, np.cumsum(n)]
                at = pa.array(cuts.astype(np.int32))
                lists = [pa.ListArray.from_arrays(at, pa.array(x)) for x in (ids, begin, end)]
                every = ids.tolist()
                decoded = [own.library.decode(every[a:b]) if b > a else "" for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                columns = [part["row"].combine_chunks(), *lists, pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)
                lo = hi

    return run


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (without the text), with its pieces.

    ``ids``; ``begin`` and ``end``, the bytes of the original text that each piece stands for
    (a piece that stands for none, such as the mark put in front, has ``begin = end``);
    ``decoded``, the library's decoding of the ids. Null is encoded as the empty text, which
    has no pieces. Works row by row, without a shuffle.
    """
    others = [docs[c] for c in docs.columns if c != text_col]
    given = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), docs[text_col].cast("string").alias("text"))
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType(
        [T.StructField("row", given.schema["row"].dataType), *[T.StructField(c, numbers) for c in ("ids", "begin", "end")], T.StructField("decoded", T.StringType())]
    )
    return given.mapInArrow(_encode(model_path, to_arrow_schema(schema)), schema)
