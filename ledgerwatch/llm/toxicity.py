"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon holds words and word beginnings that toxic documents have far more often than
others. Texts are scored with the lexicon of all labelled training rows. For learning, these
rows are dealt into four parts by hash, and the features of each part come from the lexicon of
the other three, so no row is judged by a lexicon that has seen it. Three parts teach the
trees, and the fourth the calibration from the trees' score to a probability.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.workspace import stage

#: Labelled documents that are learned from, taken in order of a hash of the id.
MAX_TRAINING = 60_000
#: A lexicon entry is in so many toxic documents, and so much likelier in them.
LEAST_DOCS, LEAST_ODDS = 3, 5.0
#: Characters of a word's beginning.
BEGINNING = 5
#: Parts of the training rows; the last one is for calibration.
PARTS = 4
#: Words to either side of a second-person pronoun that count as near.
NEAR = 5
TREES, DEPTH = 24, 4
THRESHOLD = 0.7

# Second-person pronouns of the corpus languages.
SECOND_PERSON = set("you your yours yourself u ur thou thee tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch euer sie ihnen tú ti tuyo usted ustedes vosotros".split())
_PLAIN = str.maketrans({"@": "a", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "$": "s", "!": "i"})
_INNER = re.compile(r"(?<=\w)[^\w\s'’-]+(?=\w)|(?<=[a-z])[0-9]+(?=[a-z])")
_LONG = re.compile(r"(.)\1{2,}")
_MARKS = ".,;:!?\"'()[]{}<>|-_#*$%&@/\\"
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
FEATURES = ["lexicon", "beginnings", "weight", "top", "hits", "starts", "near_you", "you", "capitals", "shouted", "exclaims", "punctuation", "obfuscated", "length"]


def plain_word(raw: str) -> str:
    """A word without case, edges and disguises."""
    word = _EDGE.sub("", raw.lower())
    return _LONG.sub(r"\1", re.sub(r"[\W_]+", "", word.translate(_PLAIN)))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        toxic, kind, entry, part = [], [], [], []
        for text, label, own in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "part"))):
            found = {plain_word(w) for w in set((text or "").split())} - {""}
            for k, s in (("word", found), ("start", {w[:BEGINNING] for w in found if len(w) > BEGINNING})):
                entry += s
                kind += [k] * len(s)
                toxic += [label] * len(s)
                part += [own] * len(s)
        columns = [pa.array(kind, pa.string()), pa.array(entry, pa.string()), pa.array(toxic, pa.int64()), pa.array(part, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "entry", "toxic", "part"])


Lexicon = dict[str, dict[str, float]]


def learn_lexicons(rows: DataFrame) -> tuple[Lexicon, list[Lexicon]]:
    """Log odds of words and beginnings from (``part``, ``text``, ``toxic``): of all rows, and without each part.

    Every entry with enough evidence is in. Their number is bounded by the text of the rows, at
    most ``MAX_TRAINING`` documents, of which each entry needs ``LEAST_DOCS`` toxic ones.
    """
    held: list[Lexicon] = [{"word": {}, "start": {}} for _ in range(PARTS + 1)]
    bad, good = F.col("toxic"), 1 - F.col("toxic")
    sides = [F.when(F.col("part") != k, 1).otherwise(0) for k in range(PARTS)] + [F.lit(1)]
    sums = [F.sum(v * side).alias(f"{name}{k}") for k, side in enumerate(sides) for name, v in (("bad", bad), ("good", good))]
    totals = rows.agg(*sums).first()
    seen = rows.mapInArrow(_words, "kind string, entry string, toxic long, part long").groupBy("kind", "entry").agg(*sums)
    weights = []
    for k in range(PARTS + 1):
        of = lambda name: (F.col(f"{name}{k}") + 0.5) / ((totals[f"{name}{k}"] or 0) + 1.0)  # noqa: B023, E731
        weight = F.log(of("bad") / of("good"))
        weights.append(F.when((F.col(f"bad{k}") >= LEAST_DOCS) & (F.exp(weight) >= LEAST_ODDS), weight).alias(f"w{k}"))
    known = seen.select("kind", "entry", *weights).where(F.coalesce(*[f"w{k}" for k in range(PARTS + 1)]).isNotNull())
    for row in known.collect():
        for k in range(PARTS + 1):
            if row[f"w{k}"] is not None:
                held[k][row["kind"]][row["entry"]] = row[f"w{k}"]
    return held[PARTS], held[:PARTS]


class Features:
    """Dense features of texts under a lexicon. What a raw word is like is found once."""

    REMEMBERED = 400_000

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.memory, self.table = lexicon, {}, array("d")

    def _meet(self, raw: str) -> int:
        core = raw.strip(_MARKS)
        if core.isalpha():  # most words: nothing to take apart
            low = core.lower()
            long = _LONG.search(low)
            word = _LONG.sub(r"\1", low) if long else low
            upper = 0 if low == core else sum(c.isupper() for c in core)
            held, odd = len(core), bool(long)
            marks, exclaims = len(raw) - held, raw.count("!") if held < len(raw) else 0
        else:
            word, core = plain_word(raw), _EDGE.sub("", raw).lower()
            letters = [c for c in raw if c.isalpha()]
            upper, held = sum(c.isupper() for c in letters), len(letters)
            odd = bool(_INNER.search(core)) or bool(_LONG.search(core))
            marks, exclaims = len(raw) - sum(c.isalnum() for c in raw), raw.count("!")
        self.table.extend(
            (
                self.lexicon["word"].get(word, 0.0),
                self.lexicon["start"].get(word[:BEGINNING], 0.0) if len(word) > BEGINNING else 0.0,
                word in SECOND_PERSON,
                upper,
                held,
                held > 2 and upper == held,
                exclaims,
                marks,
                odd,
            )
        )
        self.memory[raw] = len(self.memory)
        return self.memory[raw]

    def of(self, texts: list[str]) -> np.ndarray:
        if len(self.memory) > self.REMEMBERED:
            self.memory, self.table = {}, array("d")
        known, out = self.memory, np.zeros((len(texts), len(FEATURES)))
        split = [t.split() for t in texts]
        ids = [[known[w] if w in known else self._meet(w) for w in words] for words in split]
        table = np.frombuffer(self.table).reshape(-1, 9)
        for i, (text, at) in enumerate(zip(texts, ids)):
            n = len(at)
            if not n:
                continue
            word, start, you, upper, letters, shouted, exclaims, marks, odd = table[at].T
            hit = word > 0
            near = np.convolve(you, np.ones(2 * NEAR + 1))[NEAR:-NEAR] > 0
            chars = max(len(text), 1)
            out[i] = (
                hit.mean(), (start > 0).mean(), word.sum() / n, word.max(), min(hit.sum(), 20), min((start > 0).sum(), 20),
                (hit & near).mean(), you.mean(), upper.sum() / max(letters.sum(), 1), shouted.mean(),
                exclaims.sum() / chars, marks.sum() / chars, odd.mean(), np.log1p(n),
            )
        del table
        return out


def featured(rows: DataFrame, lexicon: Lexicon, keep: str) -> DataFrame:
    """``rows`` (``keep`` columns and ``text``) with a column per feature in place of the text."""
    names = [f.split()[0] for f in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(lexicon)
        for batch in batches:
            size = 512
            for lo in range(0, batch.num_rows, size):
                part = batch.slice(lo, size)
                values = features.of([t or "" for t in part.column("text").to_pylist()])
                columns = [part.column(n) for n in names] + [pa.array(v) for v in values.T.copy()]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *FEATURES])

    return rows.select(*names, "text").mapInArrow(run, f"{keep}, {', '.join(f + ' double' for f in FEATURES)}")


def remainder(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 3


def train(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, object, object]:
    """Lexicon, trees and calibration from ``docs`` (``id``, ``text``) and ``labels`` (``id``, ``toxic``).

    Rows whose :func:`remainder` is 1 are never read. Learns from the first ``MAX_TRAINING``
    labelled rows in order of a hash. Without both labels there is no model: (lexicon, None, None).
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & (remainder(F.col("id")) != 1)).groupBy("id").agg(F.max("toxic").cast("long").alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("id"), "id").limit(MAX_TRAINING)
    rows = docs.join(chosen.withColumnRenamed("id", "labelled"), docs.id == F.col("labelled")).select("id", "text", "toxic")
    rows = stage(rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit("part")), F.lit(PARTS))), "toxic-training")
    lexicon, without = learn_lexicons(rows)
    parts = [featured(rows.where(F.col("part") == k), without[k], "part long, toxic long") for k in range(PARTS)]
    table = reduce(DataFrame.unionByName, parts)
    table = stage(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).select("part", "toxic", "features"), "toxic-features")
    table = table.coalesce(4)
    if table.select("toxic").distinct().count() < 2:
        return lexicon, None, None
    trees = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7).fit(table.where(F.col("part") < PARTS - 1))
    judged = trees.transform(table.where(F.col("part") == PARTS - 1)).select(F.col("toxic").cast("double").alias("toxic"), vector_to_array("probability")[1].alias("raw"))
    scale = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="score").fit(judged)
    return lexicon, trees, scale


def score(docs: DataFrame, model: tuple[Lexicon, object, object]) -> DataFrame:
    """``id``, ``score`` and ``predicted`` for every row of ``docs`` (``id``, ``text``). Null texts are empty."""
    lexicon, trees, scale = model
    table = featured(docs, lexicon, "id long")
    if trees is None:
        return table.select("id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table).select("id", "features")
    raw = trees.transform(table).select("id", vector_to_array("probability")[1].alias("raw"))
    # A step function has few values; a trace of the trees' own score keeps their order.
    value = F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)) * 0.999 + F.col("raw") * 0.001
    return scale.transform(raw).select("id", value.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``; repeated rows give equal rows.

    Only texts enter a score. A document with several labels counts as toxic if one says so.
    """
    docs = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    labels = labels.select(labels[id_col].cast("long").alias("id"), labels[label_col].alias("toxic"))
    out = score(docs, train(docs, labels))
    return out.select("id", (remainder(F.col("id")) == 1).alias("held_out"), "score", "predicted")
