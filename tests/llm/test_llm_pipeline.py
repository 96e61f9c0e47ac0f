"""The pipeline's stages and its rows against plain Python, on planted and awkward rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwatch.llm import blocks, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, source string, lang string, n_chars long, id long, row string, size int, n long, sig string"


def plain_rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(2000)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(rng.randint(15, 90)), ["web", "books", None][i % 3]) for i in range(60)]
    base, passage = text(90), text(55)
    for i in range(60, 90):  # near copies, most of them at 0.8 or more
        copy = base.split()
        for at in rng.sample(range(90), rng.randint(0, 2)):
            copy[at] = rng.choice(words)
        rows.append((i, " ".join(copy), "web" if i % 2 else "books"))
    rows += [(i, f"{text(20)}\n{passage}\n{text(25)}", "books") for i in range(90, 100)]
    rows += [(i, "too short", "bad") for i in range(100, 400)] + [(400, text(60), "bad")]
    rows += [(401, None, "web"), (402, "", "web"), (403, " \n\t ", None), (404, "again and again " * 40, "web")]
    rows += [(405, text(30_000), "web"), rows[5], rows[5], (None, text(40), "web"), (None, base, "web"), (406, base.upper(), "")]
    return [(i, t, s, "en", len(t or ""), 7, "r", 8, 9, "x") for i, t, s in rows]


def failed(text):
    w = WORD.findall(text or "")
    spans = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(spans)
    held = {k + j for k, s in enumerate(spans) if often[s] > 1 for j in range(5)}
    return len(w) < 10 or 100 * len(held) > 20 * len(w)


def after_rules(rows):
    return [r for r in rows if not failed(r[1]) and r[2] != "bad"]


def after_join(rows):
    def shingles(text):
        w = WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))
        return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1)))

    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if group[i] != group[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for r, g in zip(rows, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return [r for r, g in zip(rows, group) if r[0] is None or least[g] == r[0]]


def after_passages(rows):
    last, first = 2**63 - 1, {}
    rank = lambda r: last if r[0] is None else r[0]
    for r in rows:
        for at in range(len(r[1]) - 49):
            s = r[1][at : at + 50]
            first[s] = min(first.get(s, last), rank(r))
    out = []
    for r in rows:
        gone = set()
        for at in range(len(r[1]) - 49):
            if first[r[1][at : at + 50]] < rank(r):
                gone.update(range(at, at + 50))
        text = "".join(c for k, c in enumerate(r[1]) if k not in gone)
        out.append((r[0], text, r[2], r[3], len(text), *r[5:]))
    return out


def plain_targets(rows):
    size = defaultdict(int)
    for r in rows:
        size[r[2]] += len(WORD.findall(r[1] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(size.values()), set(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / whole > 2 * size[s]}
        if not over:
            target |= {s: left * weight[s] / whole for s in open_}
            break
        for s in over:
            target[s] = 2 * size[s]
        left, open_ = left - sum(target[s] for s in over), open_ - over
    return target


def check_mix(given, taken):
    """``taken`` are given rows, each at most twice as often, and each source's words come near its target."""
    most = Counter(given)
    assert all(n <= 2 * most[row] for row, n in Counter(taken).items())
    for source, target in plain_targets(given).items():
        words = [len(WORD.findall(r[1])) for r in taken if r[2] == source]
        longest = max(len(WORD.findall(r[1])) for r in given if r[2] == source)
        assert abs(sum(words) - target) <= longest


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(plain_rows(), COLUMNS).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


def test_every_stage_against_plain_python(spark, folder):
    docs, rows = queries.table(spark, folder, "documents"), plain_rows()
    for step, plain in zip(corpus_pipeline.STAGES, (after_rules, after_join, after_passages)):
        before = len(rows)
        docs, rows = step[1](spark, docs, folder), plain(rows)
        assert docs.columns == COLUMNS.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
        assert Counter(map(tuple, docs.collect())) == Counter(rows)
        assert len(rows) < before or plain is after_passages
    mix = corpus_pipeline.source_mix(spark, docs, folder)
    check_mix(rows, [tuple(r) for r in mix.collect()])
    assert Counter(mix.collect()) == Counter(corpus_pipeline.source_mix(spark, docs, folder).collect())


def test_rows_of_the_whole_run(spark, folder):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    given = after_passages(after_join(after_rules(plain_rows())))
    by_pieces = {}
    for r in given:
        by_pieces.setdefault((r[0], r[2], tuple(library.encode(r[1]))), []).append(r)
    assert all(len(set(same)) == 1 for same in by_pieces.values())
    taken = []
    for r in corpus_pipeline.run(spark, folder).collect():
        row = by_pieces[r["doc_id"], r["source"], tuple(r["ids"])][0]
        assert r["n_tokens"] == len(r["ids"]) and list(r["ends"])[-1:] == ([len(row[1].encode())] if row[1] else [])
        taken.append(row)
    check_mix(given, taken)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("buckets", [1, 3, 211, (1 << 16) + 1, 20_000_000])
def test_places_rise_with_the_hash(buckets):
    import numpy as np

    edge = [0, 1, 2**32 - 1, 2**32, 2**63, 2**64 - 2**31, 2**64 - 1]
    h = np.sort(np.r_[np.random.default_rng(3).integers(0, 2**64, 1000, dtype=np.uint64), np.array(edge, np.uint64)])
    bucket, rest = blocks.place(h, buckets)
    want = [divmod(int(x) * buckets >> 32, 2**32) for x in h]
    assert list(zip(bucket.tolist(), rest.tolist())) == want == sorted(want)
