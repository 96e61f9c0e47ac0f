"""Ranked search against a plain version."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet
import pytest

from ledgerwatch.llm import queries, ranked_search
from testbed.compare import difference, open_oracle

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected(docs, items, most=10):
    held = [(i, Counter(terms_of(t))) for i, t in docs]
    every, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms_of(t))
    out = []
    for item, own in asked.items():
        scores = []
        for i, c in held:
            m = 10 + 90 * c.total() * every // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * every + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        scores.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, k, i, -s) for k, (s, _, i) in enumerate(scores[:most], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **settings):
    d = queries.workers_import(spark).createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int")
    b = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, rank string")
    return sorted((tuple(r) for r in ranked_search.ranked(d, b, **settings).collect()), key=repr)


DOCS = [
    (1, None), (2, ""), (3, " .,\n"), (4, "One two three"), (5, "one TWO"), (5, "one TWO"), (None, "one two"), (None, "one"), (6, "Été déjà l'été"), (7, "three " * 500),
    (8, "x_y z-9 naïve"), (9, "one " * 20_000 + "rare"), (10, "two"), (-4, "two"), *[(k, "copy of the same words one two") for k in range(20, 40)],
]
ITEMS = [(1, "one two"), (2, None), (3, ""), (4, "nothing-found"), (5, "ÉTÉ été"), (6, "x y z 9"), (7, "one"), (7, "rare three"), (None, "two"), (8, "one one one")]


def test_awkward_texts(spark):
    assert found(spark, DOCS, ITEMS) == expected(DOCS, ITEMS)
    assert found(spark, DOCS, ITEMS, most=3) == expected(DOCS, ITEMS, 3)
    assert found(spark, DOCS, []) == found(spark, [], ITEMS) == []


def test_awkward_texts_agree_with_sql(spark, tmp_path):
    for name, rows, schema in (("documents", DOCS, "doc_id long, text string"), ("benchmark", ITEMS, "item_id long, text string")):
        pa.parquet.write_table(spark.createDataFrame(rows, schema).toArrow(), f"{tmp_path}/{name}.parquet")
    result = queries.op11_ranked_search(spark, str(tmp_path))
    assert difference(result, open_oracle(str(tmp_path)), queries.ORACLES["op11_ranked_search"]) == ""


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "PAIRS_AT_ONCE", 4)
    assert found(spark, DOCS, ITEMS) == expected(DOCS, ITEMS)


@pytest.mark.parametrize("share, block, wide", [(1 << 20, 32, 8 << 20), (900, 3, 0)])
def test_blocks_are_skipped_and_nothing_is_lost(monkeypatch, share, block, wide):
    for name, value in (("SHARE", share), ("BLOCK", block), ("WIDE", wide)):
        monkeypatch.setattr(ranked_search, name, value)
    draw = random.Random(9)
    words = [f"w{k}" for k in range(120)]
    topics = [draw.sample(words, 12) for _ in range(25)]
    docs = []
    for i in draw.sample(range(100_000), 1_500):
        docs.append((i, " ".join(draw.choices(draw.choice(topics), k=draw.randrange(4, 30)) + draw.choices(words[:9], k=12))))
    items = [(k, " ".join(draw.sample(topics[k % 25], 6) + draw.sample(words[:9], 4))) for k in range(40)]
    vocabulary = np.unique(np.concatenate([b["term"].to_numpy().view(np.uint64) for b in ranked_search._terms([batch_of(items)])]))
    vectors = list(ranked_search._vectors(vocabulary)([batch_of(docs)]))
    every, total = len(docs), sum(b["n"].to_numpy().sum() for b in vectors)
    df = np.bincount(np.concatenate([b["terms"].flatten().to_numpy() for b in vectors]), minlength=len(vocabulary))
    weights = np.array([ranked_search.weight(every, int(n)) for n in df])
    lists = []
    for i, text in items:
        own = np.searchsorted(vocabulary, np.unique(next(ranked_search._terms([batch_of([(i, text)])]))["term"].to_numpy().view(np.uint64)))
        lists.append((i, own[np.lexsort((own, -weights[own]))]))
    shares = []

    class Watched(ranked_search.Share):
        def __init__(self, *given):
            super().__init__(*given)
            shares.append(self)

    monkeypatch.setattr(ranked_search, "Share", Watched)
    rows = [r for b in ranked_search._search(lists, weights, every, int(total), 10)(vectors) for r in zip(*(b[c].to_pylist() for c in ("item", "id", "score")))]
    assert sorted(rows) == sorted((item, i, s) for item, _, i, s in expected(docs, items))
    assert sum(s.skipped for s in shares) > 40
    # A summary is the largest impact of each term in its block.
    one = shares[0]
    term = int(np.argmax(np.diff(one.bound)))
    columns, summary = one._summary(term, lists[0][1])
    listed = one.listed[one.bound[term] : one.bound[term + 1]]
    for k in range(len(summary)):
        for c, t in enumerate(columns.tolist()):
            own = [one.impact[e] for d in listed[k * block : (k + 1) * block] for e in range(one.start[d], one.start[d] + one.sizes[d]) if one.term[e] == t]
            assert summary[k, c] == max(own, default=0)


def batch_of(rows):
    return pa.record_batch([pa.array([i for i, _ in rows], pa.int64()), pa.array([t or "" for _, t in rows])], names=["id", "text"])
