"""Pages, shards, vectors, toxicity and the pipeline against brute force."""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerwatch.llm import cap_filters, html_extraction, lookup_sharding, queries, toxicity, warc

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "word " * 400 + "</p>"
    rows = [(1, "http://a.org/1", long), (2, "http://a.org/2", long), (5, None, long), (None, "http://a.org/x\ny%0A", long), (2, "http://a.org/2", long)]
    rows += [(6, "u", None), (7, "u", ""), (8, "u", "short"), (9, "u", "short"), (10, "http://b.org/", "<p>" + "é\r\n\r\n" * 90_000)]
    return queries.workers_import(spark).createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, id string, digest int")


def warc_rows(df, spark):
    files = warc.write_archives(df, warc.archive_folder(spark))
    return warc.read_archives(files).collect()


@pytest.mark.parametrize("which", ["awkward", "small", "empty"])
def test_warc_round_trip(spark, pages, which):
    df = {"awkward": pages, "small": queries.table(spark, SMALL, "pages"), "empty": pages.limit(0)}[which]
    rows = [(r["page_id"], r["url"], (r["html"] or "").encode()) for r in df.collect()]
    last: dict[bytes, int] = {}
    for i, _, p in rows:
        if len(p) >= 1000 and i is not None:
            last[p] = max(last.get(p, i), i)
    want = Counter()
    for i, u, p in rows:
        revisit = p in last and i != last[p]
        want[i, u, "revisit" if revisit else "response", last[p] if revisit else None, len(p), hashlib.sha1(p).hexdigest(), None if revisit else p] += 1
    out = warc_rows(df, spark)
    assert Counter((*r[:-1], None if r[-1] is None else bytes(r[-1])) for r in out) == want


def test_warc_members_and_damage():
    one, two = (warc.record([("WARC-Type", "response")], b"x" * n) for n in (10, 200_000))
    assert gzip.decompress(one + two).count(b"WARC/1.1") == 2
    assert [len(b) for _, b in warc.read_records(io.BytesIO(one + two))] == [10, 200_000]
    wrong = gzip.compress(zlib.decompress(one, 31).replace(b"xxxx\r\n\r\n", b"xxxy\r\n\r\n"))
    for bad in (one + two[:-9], wrong, gzip.compress(b"nothing"), one[:-1]):
        with pytest.raises(warc.DamagedRecord):
            list(warc.read_records(io.BytesIO(bad)))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<article></article>", ""), ("plain &amp; simple", "plain & simple"),
        ("<body><nav>menu</nav><article><h1>T</h1><p>a <b>b</b>c<br>d<p>e &eacute;&#233;</article><footer>f</footer>", "T a bc d e éé"),
        ("<main><header>h</header><p>x<aside>side</aside>y</p><form>f<input></form><script>var a='</p><p>'</script></main>", "x y"),
        ("<article><p>one</p><div class='ad box'>buy</div><section id=comments><p>me too</p></section><!-- <p>no</p> --><p>two", "one two"),
        ("<article><p>1 < 2 and 3 > 2</p><div class='cookieNotice'>c</div><ul><li>a<li>b</ul></article>", "1 < 2 and 3 > 2 a b"),
        ("<div role=navigation>n</div><div role=main>kept<style>s{}</style></div>rest", "kept"),
        ("<article><article class='comment'>hi</article>story</article>", "story"),
    ],
)
def test_page_text(spark, page, text):
    df = queries.workers_import(spark).createDataFrame([(1, "http://h/", page)], "page_id long, url string, html string")
    assert html_extraction.main_text(df).first()["text"] == text


def test_host_boilerplate(spark):
    menu = "home news sport weather travel culture money science contact"
    rows = [(i, f"http://h.org/{i}", f"<div>{menu}</div><p>story number {i} of the day is about {'x' * (i + 1)}</p><div>all rights are reserved by the publisher of this fine paper</div>") for i in range(6)]
    rows += [(10, "http://other.org/", f"<div>{menu}</div><p>alone</p>"), (11, "http://h.org/0", rows[0][2])]
    out = {r["id"]: r["text"] for r in html_extraction.main_text(queries.workers_import(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[3] == "story number 3 of the day is about xxxx"
    assert out[10] == f"{menu} alone"
    assert out[0] == out[11] == "story number 0 of the day is about x"


@pytest.mark.parametrize(
    "page, text",
    [
        # Names of wrappers, around marked and unmarked text.
        ("<div class='layout has-sidebar'><article>story</article></div>", "story"),
        ("<div class='content-sidebar-wrap'><article>story</article><div class='sidebar'>side</div></div>", "story"),
        ("<div id='page' class='no-comments'><article>story</article></div>", "story"),
        ("<div class='sidebar'><div class='post-content'>story</div></div><nav>menu</nav>", "story"),
        ("<div class='page has-sidebar'><p>story</p><div id='sidebar'>side</div></div>", "story"),
        ("<body class='comments'><div class='banner'><main>story</main></div><article>one card that is longer</article>", "story one card that is longer"),
        # Parts of an article about what also names a box.
        ("<article><p>one</p><section id='social'><h2>Social</h2><p>two</p></section><section class='related-work'><p>three</p></section></article>", "one Social two three"),
        ("<article><p>one</p><section class='share'><p>shares rose by <a href=x>two</a> per cent</p></section><div class='alert'>the earlier version was wrong here</div></article>", "one shares rose by two per cent the earlier version was wrong here"),
        # Boxes still go.
        ("<article><p>one</p><div class='share'><a>mail</a> <a>print</a></div><ul class='related'><li><a>other story</a></ul><div class='comment-list'><p>me</p></div><div class='siteFooter'>f</div></article>", "one"),
        ("<article>a story of five words<div class='related'><article>a card</article></div></article>", "a story of five words"),
        ("<article>story of some length</article><section id=comments><article class='comment'>a reply that is longer than that</article></section>", "story of some length"),
        # Cards beside the region that holds the text.
        ("<main><h1>T</h1><p>the story is told in main</p></main><article class='card'>a card</article>", "T the story is told in main"),
        ("<article class='card'>a card</article><div class='story-body'>the story is told here</div>", "the story is told here"),
        ("<main><div class='article-body'>the story is told here</div><article>a card</article></main>", "the story is told here"),
        ("<main><p>the story is told in main</p><article>with a part in an article</article><p>and goes on</p></main>", "the story is told in main with a part in an article and goes on"),
        ("<main>title</main><article>the story is longer than the title</article>", "title the story is longer than the title"),
        ("<article><h1>T</h1><div class='article-body'>story</div><p>end</p></article>", "T story end"),
    ],
)
def test_names_and_regions(page, text):
    assert " ".join(html_extraction.page_blocks(page)[0]) == text


@pytest.mark.parametrize("host_bytes", [html_extraction.HOST_BYTES, 0])
def test_the_host_comparison_speaks_on_marked_pages(spark, monkeypatch, host_bytes):
    """A notice in every article goes; paragraphs of near copies and quotes stay, in one shard and in many."""
    monkeypatch.setattr(html_extraction, "HOST_BYTES", host_bytes)
    rng = np.random.default_rng(5)
    words = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    notice, quoted, article = words(14), words(20), [words(30) for _ in range(3)]
    page = lambda *ps: f"<nav>menu</nav><article>{''.join(f'<p>{p}</p>' for p in ps)}<p>{notice}</p></article>"
    texts = [[words(30), quoted] if i % 2 else [words(25), words(12)] for i in range(12)]
    texts += [[*article[:2], f"{article[2]} changed{i}"] for i in range(30)]
    rows = [(i, "http://paper.org/", page(*ps)) for i, ps in enumerate(texts)]
    want = {i: " ".join(ps) for i, ps in enumerate(texts)}
    # Seven different pages are too few to tell, and unmarked ones need three.
    few = [words(20) for _ in range(7)]
    rows += [(100 + i, "http://few.org/", page(t)) for i, t in enumerate(few)]
    want |= {100 + i: f"{t} {notice}" for i, t in enumerate(few)}
    rows += [(200 + i, "http://open.org/", f"<div>{notice}</div><p>{t}</p>") for i, t in enumerate(few)] + [(207, "http://open.org/", None)]
    want |= {200 + i: t for i, t in enumerate(few)} | {207: ""}
    rows.append(rows[0])
    out = html_extraction.main_text(queries.workers_import(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(out) == len(rows)
    assert {r["id"]: r["text"] for r in out} == want


def test_near_copies_and_quotes_on_unmarked_pages(spark):
    """Near copies keep their paragraphs, quoted paragraphs stay, and what all pages hold goes."""
    rng = np.random.default_rng(11)
    words = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    menu, foot = words(25), words(12)
    page = lambda *ps: f"<div>{menu}</div>" + "".join(f"<p>{p}</p>" for p in ps) + f"<div>{foot}</div>"
    texts: list[tuple[str, list[str]]] = []
    article = [words(30) for _ in range(4)]
    for i in range(10):  # near copies, most of the host's pages: one word changed
        paragraphs = [p.split() for p in article]
        paragraphs[i % 4][i + 3] = f"changed{i}"
        texts.append(("http://near.org/", [" ".join(p) for p in paragraphs]))
    texts += [("http://near.org/", [words(40), words(20)]) for _ in range(4)]
    quoted = words(20)
    texts += [("http://quote.org/", [words(30), quoted]), ("http://quote.org/", [quoted, words(25), words(15)])]
    texts += [("http://quote.org/", [words(45)]) for _ in range(6)]
    for _ in range(5):  # each story twice, for print with one word more
        story = [words(30), words(30)]
        texts += [("http://print.org/", story), ("http://print.org/", [story[0], story[1] + " printed"])]
    rows = [(i, u, page(*ps)) for i, (u, ps) in enumerate(texts)]
    want = {i: " ".join(ps) for i, (_, ps) in enumerate(texts)}
    # Two near copies and a quote among two pages, alone on their hosts: all of it is kept.
    alone = [("http://two.org/", article), ("http://two.org/", [*article[:3], article[3] + " more"]), ("http://pair.org/", [quoted, words(30)]), ("http://pair.org/", [words(30), quoted])]
    rows += [(100 + i, u, page(*ps)) for i, (u, ps) in enumerate(alone)]
    want |= {100 + i: " ".join([menu, *ps, foot]) for i, (_, ps) in enumerate(alone)}
    df = queries.workers_import(spark).createDataFrame(rows, "page_id long, url string, html string")
    out = {r["id"]: r["text"] for r in html_extraction.main_text(df).collect()}
    wrong = sorted(i for i in want if out[i] != want[i])
    print("wrong", len(wrong), "of", len(want), "words", sum(len(out[i].split()) for i in want), "of", sum(len(t.split()) for t in want.values()))
    assert not wrong and len(out) == len(want)


def test_copies_do_not_fill_a_block(spark, monkeypatch):
    """A third of the unmarked rows are copies of one page; no group holds them together."""
    apply, groups = GroupedData.applyInArrow, []

    def spy(self, func, schema):
        if "blocks" in self._df.columns:
            groups.append(self._df.groupBy("block").count().agg(F.max("count")).first()[0])
        return apply(self, func, schema)

    monkeypatch.setattr(GroupedData, "applyInArrow", spy)
    rows = [(i, "http://h.org/", f"<p>text {i} alone</p>") for i in range(200)] + [(i, "http://h.org/", "<p>one page</p>") for i in range(200, 300)]
    rows += [rows[-1], (None, None, "<p>one page</p>"), (None, None, None)]
    out = html_extraction.main_text(queries.workers_import(spark).createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = Counter((i, u, (h or "")[3:-4]) for i, u, h in rows)
    assert Counter(tuple(r) for r in out) == want
    print("largest group", groups)
    assert groups and max(groups) < 40


def test_suffix_ranks():
    tokens = np.array([1, 2, 3, 1, 2, 3, 9, 1, 2, 3], np.uint64)
    stops = np.array([6] * 6 + [10] * 4)
    rank = html_extraction.suffix_ranks(tokens, stops, 2)
    assert rank[0] == rank[3] == rank[7] and rank[1] == rank[4] == rank[8]
    assert rank[5] == rank[9] == -1 and rank[2] != rank[5]


def test_lookup_table(spark):
    table = lookup_sharding.fill()
    held = Counter(table)
    assert len(table) == lookup_sharding.SLOTS and max(held.values()) - min(held.values()) <= 1
    fewer = lookup_sharding.fill(lookup_sharding.SHARDS[:-1])
    moved = sum(a != b for a, b in zip(table, fewer) if a != len(lookup_sharding.SHARDS) - 1)
    assert moved / len(table) < 0.05
    for shards, slots in (((), 7), (("a", "a"), 7), (("a",), 8)):
        with pytest.raises(ValueError):
            lookup_sharding.fill(shards, slots)
    assert lookup_sharding.fill(("a",), 2) == [0, 0]
    docs = spark.createDataFrame([(1, "s"), (1, "t"), (None, "u")], "doc_id long, slot string")
    out = lookup_sharding.assign(docs, docs["doc_id"]).collect()
    want = int(hashlib.md5(b"1").hexdigest()[:15], 16) % lookup_sharding.SLOTS
    assert sorted(r["slot"] for r in out if r["row"]["doc_id"] == 1) == [want, want]
    assert all(r["shard"] == lookup_sharding.SHARDS[table[r["slot"]]] for r in out)


def brute_vectors(rows, cosine=0.98):
    x = []
    for _, v, label in rows:
        ok = label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if ok else None)
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]) and x[i] @ x[j] >= cosine:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return Counter((r[0], links[i], least.get(root(i)), r[0] == least.get(root(i))) for i, r in enumerate(rows))


@pytest.mark.parametrize("which", ["awkward", "small", "empty", "chunks"])
def test_near_vectors(spark, which, monkeypatch):
    df = queries.table(spark, SMALL, "embeddings")
    if which != "small":
        rng = np.random.default_rng(3)
        base = rng.standard_normal(16)
        rows = [(i, (base + 0.05 * rng.standard_normal(16)).tolist(), i % 2) for i in range(60)]
        rows += [(100, None, 1), (101, [], 1), (102, [0.0] * 16, 1), (103, [1.0, None] * 8, 1), (104, [float("nan")] * 16, 0)]
        rows += [(105, [float("inf")] * 16, 0), (106, rows[0][1], None), (107, [1.0, 2.0], 0), (108, [2.0, 4.0], 0)]
        rows += [rows[4], rows[4], (None, rows[4][1], 0), (None, rng.standard_normal(16).tolist(), 1)]
        df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, label int, id string, key int")
        df = df.limit(0) if which == "empty" else df
    if which == "chunks":
        monkeypatch.setattr(cap_filters, "CHUNK", 7)
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert Counter(tuple(r) for r in cap_filters.near_vectors(df).collect()) == brute_vectors(rows)


def test_filter_recall(spark):
    """Of pairs at the cosine or just above, at least nine in ten share a filter, by brute force."""
    x = np.array([r[0] for r in queries.table(spark, SMALL, "embeddings").select("embedding").collect()], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rng = np.random.default_rng(1)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.98, 0.985, (len(x), 1))
    near = cosine * x + np.sqrt(1 - cosine**2) * side
    sets = [[set(f.tolist()) for f in cap_filters.list_filters(v)] for v in (x, near)]
    assert np.mean([bool(a & b) for a, b in zip(*sets)]) >= 0.98


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    out = toxicity.toxicity(queries.table(spark, folder, "documents"), queries.table(spark, folder, "labels"))
    seen = out.join(queries.table(spark, folder, "labels"), F.col("id") == F.col("doc_id")).where("held_out and toxic is not null")
    rows = seen.select("toxic", "score", "predicted").collect()
    bad = [r["score"] for r in rows if r["toxic"]]
    good = np.sort([r["score"] for r in rows if not r["toxic"]])
    area = np.mean((np.searchsorted(good, bad, "left") + np.searchsorted(good, bad, "right")) / 2 / len(good))
    caught = np.mean([r["predicted"] for r in rows if r["toxic"]])
    wrong = np.mean([r["predicted"] for r in rows if not r["toxic"]])
    print("area", area, "caught", caught, "wrong", wrong)
    assert area > 0.9 and wrong < 0.02 and caught > 0.75


def test_toxicity_awkward(spark):
    rows = [(1, None), (2, ""), (None, "you idiot"), (3, "w" * 100_000), (3, "w" * 100_000), (4, "!!! $$$ @@@")]
    docs = queries.workers_import(spark).createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (2, 0), (9, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in out)
    assert toxicity.toxicity(docs.limit(0), labels.limit(0)).count() == 0


def test_cut_characters_in_the_pipeline(spark):
    """Cuts through characters lose those characters alone; U+FFFD of a text stays."""
    shared = "a passage that two documents hold, of more than fifty bytes in all"
    other = "yet another passage that two of the documents hold, again of fifty bytes"
    rows = [(1, f"one é{shared}è end ñ{other}"), (6, f"six \ufffd ±{other} tail\ufffd"), (2, f"two \ufffd©{shared}é tail\ufffd"), (3, f"three\U0001f600 \ufffd {shared}"), (4, "\ufffd alone"), (5, None)]
    # 2: the second byte of © is that of é, the first of é that of è, so c2 and a9 are left and would join.
    want = {1: rows[0][1], 2: "two \ufffd tail\ufffd", 3: "three\U0001f600 \ufffd ", 4: "\ufffd alone", 5: "", 6: "six \ufffd  tail\ufffd"}
    docs = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, source string, n_chars long")
    out = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    print("texts", out)
    assert out == {i: (t, len(t)) for i, t in want.items()}


def test_pipeline(spark):
    docs = queries.table(spark, SMALL, "documents")
    columns, step = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SMALL)
        if name != "sentencepiece":
            assert step.columns == columns
        counts.append(step.count())
    assert counts[0] < docs.count() and counts[1] <= counts[0] and counts[2] == counts[1] and counts[4] == counts[3]
    assert corpus_pipeline.run(spark, SMALL).count() == counts[4]


def test_lexicon_without_a_part_has_not_seen_it(spark):
    words = ["vile", "grim", "calm", "blue"]
    rows = [(i % 4, f"{words[i % 4]} shared {words[(i // 4) % 4]}", int((i // 4) % 3 == 0)) for i in range(96)]
    rows += [(2, "unseenelsewhere", 1)] * 5 + [(k, "loathsome", 1) for k in range(4)] + [(k, "loathsome", 0) for k in (0,)]
    every, without = toxicity.learn_lexicons(spark.createDataFrame(rows, "part long, text string, toxic long"))

    def plain(skip):
        bad, good, totals = {}, {}, [0, 0]
        for part, text, toxic in rows:
            if part != skip:
                totals[toxic] += 1
                for word in set(text.split()):
                    side = bad if toxic else good
                    side[word] = side.get(word, 0) + 1
        odds = {w: ((n + 0.5) / (totals[1] + 1)) / ((good.get(w, 0) + 0.5) / (totals[0] + 1)) for w, n in bad.items() if n >= toxicity.LEAST_DOCS}
        return {w: np.log(o) for w, o in odds.items() if o >= toxicity.LEAST_ODDS}

    assert every["word"] == pytest.approx(plain(None)) and "unseenelsewhere" in every["word"]
    for k in range(toxicity.PARTS):
        assert without[k]["word"] == pytest.approx(plain(k))
    assert "unseenelsewhere" not in without[2]["word"] and "unseenelsewhere" in without[0]["word"]


def test_toxicity_ties_and_repeats(spark):
    """Rows with the same text have one score; a document with both labels is toxic; repeated rows repeat."""
    docs = [(i, f"{'vile scum ' * 3 if i % 4 == 0 else 'quiet green field '}{i % 7}") for i in range(240)]
    labels = [(i, int(i % 4 == 0)) for i in range(240)] + [(4, 0), (8, 0), (8, 1)]
    frame = spark.createDataFrame(docs + docs[:9], "doc_id long, text string")
    out = toxicity.toxicity(frame, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert sorted(r["id"] for r in out) == sorted(d[0] for d in docs + docs[:9])
    by_text: dict[str, set[float]] = {}
    for r in out:
        by_text.setdefault(docs[r["id"]][1], set()).add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())
    assert all(r["predicted"] == (r["id"] % 4 == 0) for r in out)


# What a comment, declaration or tag is, as one pattern; slow on broken pages.
PLAIN_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S)
BITS = ["<a ", "<a>", "</a>", "<", ">", "'", '"', " x", "/", "=", "<!--", "-->", "<!", "<?", "</p", "<P\n", "<b c='d>'>", "< 5", "é", "<é>"]


@given(st.lists(st.sampled_from(BITS), max_size=20).map("".join))
@settings(max_examples=500, deadline=None)
def test_tags_against_one_pattern(page):
    tags, found, at = html_extraction._Tags(page), [], 0
    while one := tags.after(at):
        found.append(one)
        at = one[1]
    plain = [(m.start(), m.end(), m[1] == "/", (m[2] or "").lower(), m[3] or "") for m in PLAIN_TAG.finditer(page)]
    # The pattern may give up a part of a name with quotes for what follows; names here are whole.
    if not any(set("'\"") & set(re.match(r"<?/?([^\s/>]*)", page[i:])[1]) for i in range(len(page)) if page[i] == "<"):
        assert found == plain


@pytest.mark.parametrize("page", [
    "<a " * 350_000, "<a '" * 250_000 + ">", "<a " * 300_000 + "' >", "<!" * 500_000, "<div>" * 100_000 + "</x>" * 100_000,
    "<p><button>" + "<span>" * 80_000 + "<h2>x</h2>" * 50_000, "<div class=ad>" * 40_000 + "x</div>" * 40_000, "w " * 500_000,
])
def test_a_megabyte_of_broken_markup(page):
    """Each takes well below a second; by the square it would be minutes."""
    start = time.perf_counter()
    html_extraction.page_blocks(page)
    assert time.perf_counter() - start < 5


def test_archives_are_opened_by_the_names_of_arrow():
    for path, uri in {
        "s3a://bank/x/y.gz": "s3://bank/x/y.gz", "S3A://bank/x": "s3://bank/x", "s3://bank/x": "s3://bank/x", "gs://bank/x": "gs://bank/x",
        "abfss://box@store.example/x": "abfss://box@store.example/x", "hdfs://name/x": "hdfs://name/x",
        "file:/shared/x": "file:///shared/x", "file:///shared/x": "file:///shared/x", "/shared/x": "file:///shared/x",
    }.items():
        assert warc.store_uri(path) == uri
