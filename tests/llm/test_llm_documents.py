"""The document operators against brute force, on a small table and on awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import blocks, mixing, ngram_join, quality_rules, queries, sentencepiece_codec, suffix_dedup

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, size int, block int, label int"


def awkward_rows():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = text(80), text(30)
    rows = [(i, text(rng.randint(1, 120)), None, f"s{i % 3}") for i in range(20)]
    for i in range(20, 60):
        copy = base.split()
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(80)] = rng.choice(words)
        rows.append((i, " ".join(copy), "en", None))
    rows += [(i, f"{text(5)}\n{passage}\n{text(9)}", "en", "s1") for i in range(60, 70)]
    rows += [(70, None, None, None), (71, "", "", ""), (72, " \t\n\x0b ", "en", "s2"), (73, "word", "en", "s2")]
    rows += [(74, "Œuvre naïve ñ▁ x  y\x00z \U0001f600 " * 30, "fr", "s0"), (75, "a" * 5000, "en", "s0")]
    rows += [(76, text(60_000), "en", "s0"), (None, base, "en", "s1"), (None, None, None, None)]
    rows += [rows[25], rows[25], rows[3], (25, text(40), "en", "s1")]
    return [(*r, 1, 1, "x", 2, 3, 4) for r in rows]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), COLUMNS).repartition(5)


@pytest.fixture(scope="module")
def small(spark):
    return queries.table(spark, SMALL, "documents")


@pytest.fixture(params=["awkward", "small", "empty"])
def docs(request, awkward, small):
    return awkward.limit(0) if request.param == "empty" else awkward if request.param == "awkward" else small


def pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def shingles(text):
    low = text.translate({i: i + 32 for i in range(65, 91)})
    w = WORD.findall(low)
    return frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def test_suffix_dedup(docs):
    rows = pairs(docs)
    late = 2**63 - 1
    first: dict[bytes, int] = {}
    for i, t in rows:
        b, k = t.encode(), late if i is None else i
        for at in range(len(b) - 49):
            first[b[at : at + 50]] = min(first.get(b[at : at + 50], late), k)
    want = Counter()
    for i, t in rows:
        b, gone = t.encode(), bytearray(len(t.encode()))
        for at in range(len(b) - 49):
            if first[b[at : at + 50]] < (late if i is None else i):
                gone[at : at + 50] = b"\1" * 50
        spans = tuple((m.start(), m.end()) for m in re.finditer(b"\1+", gone))
        want[i, len(b), spans, bytes(x for x, g in zip(b, gone) if not g)] += 1
    out = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r["row"]["doc_id"], r["n_bytes"], tuple(map(tuple, r["spans"])), bytes(r["kept"])) for r in out) == want


def test_merge_agrees_whatever_the_crowd(awkward, monkeypatch):
    rows = lambda: Counter((r["row"]["doc_id"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(awkward).collect())
    usual = rows()
    monkeypatch.setattr(suffix_dedup, "CROWD", -1)
    monkeypatch.setattr(suffix_dedup, "MERGE_SYMBOLS", 500)
    assert rows() == usual


def test_suffix_dedup_spreads_anchors_over_buckets():
    # An anchor has the least hash of its window: dealt by that hash, the first bucket gets 13 times its share.
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(2_000)]
    base = [rng.choice(words) for _ in range(20_000)]
    copies = [[rng.choice(words) if rng.random() < 0.05 else w for w in base] for _ in range(3)]
    docs = pa.table({"id": pa.array(range(4), pa.int64()), "text": [" ".join(c) for c in (base, *copies)]})
    key, buckets = (pa.scalar(0),), 32
    asked = suffix_dedup._sketch(50, buckets)(key, docs)

    def even(sent):
        loads = [len(d) for d in sent["data"].to_pylist()]
        return sorted(sent["bucket"].to_pylist()) == list(range(buckets)) and max(loads) < 1.5 * sum(loads) / buckets

    assert even(asked)
    told = pa.concat_tables([suffix_dedup._resolve((pa.scalar(b),), asked.filter(pc.equal(asked["bucket"], b))) for b in range(buckets)])
    assert even(told) and even(suffix_dedup._contexts_to_merge(50, buckets)(key, docs, told))


def test_suffix_dedup_sends_only_what_may_repeat():
    # Phrases shorter than a window are in twenty documents each: contexts around them hold one anchor, but no window twice.
    rng = random.Random(3)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    phrases, passage = [noise(36) for _ in range(20)], noise(90)
    texts = ["".join(noise(60) + p for p in phrases) + noise(60) for _ in range(20)]
    texts += [noise(40) + passage + noise(40) for _ in range(5)]
    docs, key = pa.table({"id": pa.array(range(25), pa.int64()), "text": texts}), (pa.scalar(0),)
    told = suffix_dedup._resolve(key, suffix_dedup._sketch(50, 1)(key, docs))
    sent = suffix_dedup._contexts_to_merge(50, 1)(key, docs, told)
    # 35,470 bytes went to the merge before, now 2,701.
    assert 0 < sum(len(d) for d in sent["data"].to_pylist()) < 10_000
    gone = suffix_dedup._spans(*blocks.utf8(docs["text"]), blocks.ids(docs["id"]), pa.concat_tables([told, suffix_dedup._merge(50)(key, sent)]), 50, 1)
    assert gone.tolist() == [d > 20 and 40 <= at < 130 for d, t in enumerate(texts) for at in range(len(t))]


@pytest.mark.parametrize("length", [20, 24, 25, 31, 50])
def test_least_documents_of_stretches(length, monkeypatch):
    rng = random.Random(length)
    beside = max(length - 24, 0)
    rows = set()
    for _ in range(400):
        anchor = rng.choice(["the anchor of these bytes", "another anchor of others "])[: min(24, length)]
        left, right = ("".join(rng.choice("ab") * 5 for _ in range(5))[:beside] for _ in range(2))
        start = rng.randint(0, len(left))
        last = rng.randint(max(0, beside - len(left) + start), len(right)) if len(right) >= beside - len(left) + start else 0
        if len(text := left[start:] + anchor + right[:last]) >= length:
            rows.add((text, len(left) - start))
    rows = [(t, p, rng.randint(0, 99)) for t, p in sorted(rows)]
    first: dict[tuple[str, str], int] = {}
    windows = [(t[p : p + 24], t[i : i + length], d) for t, p, d in rows for i in range(len(t) - length + 1)]
    for a, w, d in windows:
        first[a, w] = min(first.get((a, w), d), d)
    merged = []
    merge = suffix_dedup.smallest_documents
    monkeypatch.setattr(suffix_dedup, "smallest_documents", lambda *a: merged.append(a) or merge(*a))
    text, size, place, doc = (np.array(x) for x in (list("".join(t for t, _, _ in rows).encode()), [len(t) for t, _, _ in rows], [p for _, p, _ in rows], [d for _, _, d in rows]))
    assert suffix_dedup.least_documents(text.astype(np.uint8), size, place, doc, length).tolist() == [first[a, w] for a, w, _ in windows]
    # Strings that share no anchor with another one are not merged, and a longer anchor takes fewer rounds.
    assert length < 50 or merged and max(length - a[-1] + 1 for a in merged) <= 7


def test_contexts_do_not_depend_on_their_place_in_a_block():
    # They were cut at every 256 KB of the block, so that another order of rows gave other strings.
    rng = random.Random(11)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (150_000, 40, 600_000, 200_000, 0)]
    every = lambda rows: Counter(suffix_dedup.contexts(*blocks.utf8(pa.chunked_array([pa.array(rows)])), 50)["code"].tolist())
    assert every(texts) == every(texts[::-1]) == sum((every([t]) for t in texts), Counter())


def test_suffix_dedup_by_other_lengths(awkward):
    for length in (20, 31):
        first: dict[bytes, int] = {}
        rows = [((t or "").encode(), 2**63 - 1 if i is None else i) for i, t in ((r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect())]
        for b, k in rows:
            for at in range(len(b) - length + 1):
                first[b[at : at + length]] = min(first.get(b[at : at + length], k), k)
        want = Counter()
        for b, k in rows:
            gone = bytearray(len(b))
            for at in range(len(b) - length + 1):
                if first[b[at : at + length]] < k:
                    gone[at : at + length] = b"\1" * length
            want[k, bytes(x for x, g in zip(b, gone) if not g)] += 1
        out = suffix_dedup.remove_repeats(awkward, length=length).collect()
        assert Counter((2**63 - 1 if r["row"]["doc_id"] is None else r["row"]["doc_id"], bytes(r["kept"])) for r in out) == want


def test_small_tables_have_few_messages(spark, awkward):
    # With 211 partitions there were 633 blocks of next to nothing, with a message for each of 211 buckets.
    text = F.coalesce("text", F.lit(""))
    size = awkward.agg(F.sum(F.octet_length(text))).first()[0]
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    try:
        n, buckets = blocks.counts(spark, awkward, text, suffix_dedup.BUCKET_BYTES, suffix_dedup.LEAST_BYTES)
        assert 1 <= n == buckets <= size // suffix_dedup.LEAST_BYTES + 1
        assert blocks.counts(spark, awkward, text) == (633, 211)
        assert blocks.counts(spark, awkward.limit(0), text, suffix_dedup.BUCKET_BYTES, suffix_dedup.LEAST_BYTES) == (1, 1)
        assert blocks.counts(spark, awkward, text, 1000, 1 << 30) == (1, -(-size // 1000))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_suffix_dedup_in_many_blocks(awkward, monkeypatch):
    rows = lambda: Counter((r["row"]["doc_id"], tuple(map(tuple, r["spans"])), bytes(r["kept"])) for r in suffix_dedup.remove_repeats(awkward).collect())
    few = rows()
    monkeypatch.setattr(suffix_dedup, "LEAST_BYTES", 1)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 14)
    assert rows() == few


def test_ngram_join(docs):
    rows = pairs(docs)
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    want = Counter((doc, len(sets[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows))
    assert Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect()) == want


def test_ngram_join_without_turns_left(awkward, monkeypatch):
    rows = lambda: Counter(tuple(r) for r in ngram_join.near_duplicates(awkward).collect())
    usual = rows()
    monkeypatch.setattr(ngram_join, "TURNS", 1)
    assert rows() == usual


def rule_counts(text):
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(docs):
    rows = [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]
    want = Counter((i, *rule_counts(t)) for i, t, _ in rows)
    out = quality_rules.rule_verdicts(docs).collect()
    assert Counter((r["id"], *[r[c] for c in quality_rules.COUNTS]) for r in out) == want
    assert all(r["kept"] is not None and not (r["base_failed"] and r["kept"]) for r in out)
    hosts = Counter(s for _, t, s in rows if not rule_counts(t)[-1])
    total = Counter(s for _, _, s in rows)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in out)
    if total:  # hosts that fail little are never rejected
        assert all(hosts[s] / total[s] < 0.5 for s in total if not any(r["kept"] for r in out if r["from"] == s))


def test_a_bad_host_is_rejected(spark):
    good = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(i, f"{good} {i}", "fine") for i in range(200)] + [(1000 + i, "too short", "bad") for i in range(300)]
    rows += [(2000, good, "bad"), (3000, "short", "tiny"), (3001, good, "tiny")]
    out = {r["id"]: r for r in quality_rules.rule_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert not out[2000]["kept"] and not out[2000]["base_failed"]
    assert out[0]["kept"] and out[3001]["kept"]


def test_mixing(docs):
    rows = [(r["doc_id"], r["text"] or "", r["source"]) for r in docs.collect()]
    size = Counter()
    for _, t, s in rows:
        size[s] += len(WORD.findall(t))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, left = {}, set(names), 1.5 * sum(size.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * size[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * size[s]
            left -= target[s]
            free.discard(s)
    out = mixing.mix(docs).collect()
    assert len(out) == len(rows)
    taken, largest, groups = Counter(), Counter(), {}
    for r in out:
        assert r["source_size"] == size[r["from"]]
        assert r["target"] == pytest.approx(target[r["from"]])
        assert 0 <= r["copies"] <= 2
        taken[r["from"]] += r["copies"] * r["size"]
        groups.setdefault((r["from"], r["id"], r["digest"]), []).append(r)
    for (s, *_), g in groups.items():
        assert len({r["copies"] for r in g}) == 1
        largest[s] = max(largest[s], sum(r["size"] for r in g))
    for s in names:
        assert abs(taken[s] - target[s]) <= largest[s] / 2 + 1
    again = mixing.mix(docs.repartition(3)).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in out)


def test_mixing_with_many_sources(docs, monkeypatch):
    """Beyond ``FEW_SOURCES`` the rows of a source are dealt over salts; the result is the same."""
    plain = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(docs).collect()), key=str) == plain


def test_mixing_prefers(spark):
    rows = [(i, "w " * 10, "a" if i % 2 else "b") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs, preference=F.when(F.col("doc_id") % 4 < 2, 3).otherwise(1), share=0.4).collect()
    often = [sum(r["copies"] for r in out if (r["id"] % 4 < 2) == liked) for liked in (True, False)]
    assert 2.5 < often[0] / often[1] < 3.5


def test_sentencepiece(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    size = [1 if library.is_byte(i) else len(library.id_to_piece(i).encode()) for i in range(library.get_piece_size())]
    want = Counter()
    for i, t in pairs(docs):
        ids = library.encode(t)
        want[i, tuple(ids), library.decode(ids)] += 1
    texts = {}
    out = sentencepiece_codec.encode_documents(docs, queries.model_path()).collect()
    assert Counter((r["row"]["doc_id"], tuple(r["ids"]), r["decoded"]) for r in out) == want
    for i, t in pairs(docs):
        texts.setdefault(i, []).append(t)
    for r in out:
        if len(texts[r["row"]["doc_id"]]) > 1 or not r["ids"]:
            continue
        data, end = texts[r["row"]["doc_id"]][0].encode(), 0
        for k, b, e in zip(r["ids"], r["begin"], r["end"]):
            assert b == end and e >= b
            piece = data[b:e].replace(b" ", "▁".encode())
            assert len(piece) == size[k] or (b == 0 and len(piece) == size[k] - 3)
            end = e
        assert end == len(data)


def test_sentencepiece_queries_hash(spark):
    out = queries.op5_sentencepiece(spark, SMALL).where("doc_id = 7").first()
    codec = sentencepiece_codec.codec(queries.model_path())
    text = queries.table(spark, SMALL, "documents").where("doc_id = 7").first()["text"]
    ids = codec.library.encode(text)
    assert out["n_tokens"] == len(ids)
    assert out["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert out["decoded_sha256"] == hashlib.sha256(codec.library.decode(ids).encode()).hexdigest()


@pytest.mark.parametrize("text", ["ﬁne  Ｆｕｌｌ ｗｉｄｔｈ ①½ é", "  a b  ", "x", "", "한국어 ㎏", "éé ä"])
def test_character_map(text):
    """Normalisation and its alignment against the library's own normaliser."""
    import sentencepiece

    own = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(own.serialized_model_proto())
    normal, source = sentencepiece_codec.normalise(text, model)
    assert normal.decode() == own.normalize(text)
    assert len(source) == len(normal) + 1 and source == sorted(source)


def test_candidates_of_a_large_group_of_near_copies_grow_with_it(spark, monkeypatch):
    """A quarter equals a text, the others have up to three of its words changed."""
    plain, compared = ngram_join._linked, []

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return plain(pairs, sets, percent)

    monkeypatch.setattr(ngram_join, "_linked", counted)
    found = {}
    for n in (400, 1_600):
        draw = random.Random(1)
        rows = []
        for i in range(n):
            words = [f"w{k}" for k in range(60)]
            for _ in range(draw.randrange(4)):
                words[draw.randrange(60)] = f"x{draw.randrange(10**6)}"
            rows.append((i, " ".join(words)))
        compared.clear()
        out = ngram_join.near_duplicates(queries.workers_import(spark).createDataFrame(rows, "doc_id long, text string"))
        sets = [{tuple(w[k : k + 5]) for k in range(56)} for w in (t.split() for _, t in rows)]
        original = next(i for i, t in rows if "x" not in t)
        near = {i for i, s in enumerate(sets) if 100 * len(s & sets[original]) >= 80 * len(s | sets[original])}
        assert {r.id for r in out.where(f"component_id = {min(near)}").collect()} >= near
        found[n] = sum(compared)
    assert found[1_600] <= 5 * found[400] + 100
