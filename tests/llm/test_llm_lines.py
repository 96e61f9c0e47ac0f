"""Line dedup against a plain version."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from ledgerwatch.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"


def key_of(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def expected(rows):
    holds = defaultdict(set)
    own = lambda i: -(2**63) if i is None else i
    for i, text in rows:
        for line in (text or "").split("\n"):
            holds[key_of(line)].add(own(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(k := key_of(x)) >= 20 and len(holds[k]) >= 3 and max(holds[k]) != own(i) for x in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r["row"][0 + 1], r["text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


LONG = "this line is long enough to count"
AWKWARD = [
    (1, None), (2, ""), (3, "\n\n"), (4, LONG), (5, f"  {LONG.upper()}\t\n{LONG}"), (6, f"{LONG}\n{LONG}\nshort"), (6, f"{LONG}\nother text of the same id"),
    (7, "short\nshort"), (8, "short"), (9, "short"), (None, f"{LONG}\nmine"), (None, LONG), (10, "é" * 19 + "\n" + "ü" * 20), (11, "é" * 19 + "\n" + "ü" * 20),
    (12, "é" * 19 + "\n" + "ü" * 20 + " "), (13, "ü" * 20), (14, "\n".join(["twice in two documents only"] * 5)), (15, "twice in two documents only"),
    (-3, "\n".join(f"line number {k} of a very long text" for k in range(5_000))), (-2, "line number 17 of a very long text\nline number 4999 of a very long text"),
    (-1, "line number 17 of a very long text\r\nkept"), (4, LONG), (4, LONG),
]


@pytest.mark.parametrize("batches", [1, 7])
def test_awkward_texts(spark, batches):
    df = spark.createDataFrame([(*r, "x", 1) for r in AWKWARD], "doc_id long, text string, hash string, pos int")
    assert rows_of(line_dedup.without_repeated_lines(df, batches=batches)) == expected(AWKWARD)
    assert line_dedup.without_repeated_lines(df.limit(0), batches=batches).count() == 0


def test_random_texts_with_a_hot_line(spark):
    draw = random.Random(5)
    pool = [f"a pooled line with the number {k}" for k in range(60)]
    rows = [(i, "\n".join(draw.choices([LONG, *pool, "tiny"], weights=[40, *[1] * 60, 20], k=draw.randrange(8)))) for i in draw.sample(range(10_000), 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    result = line_dedup.without_repeated_lines(df)
    assert rows_of(result) == expected(rows)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if word in plan]


def test_places_are_not_broadcast_by_the_size_of_their_files(spark):
    # All documents but one lose the same 500 places, which compress well: the files tell little of what a broadcast would hold.
    text = "\n".join(f"{LONG}, number {k}" for k in range(500))
    rows = [(i, text) for i in range(40)]
    result = line_dedup.without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(result) == expected(rows)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_runs_are_compacted_and_any_order_gives_the_same(spark):
    draw = random.Random(6)
    holds = [(f"{draw.randrange(40):02}".encode(), i) for i in range(90) for _ in range(3)]
    lines = spark.createDataFrame(holds, "hash binary, doc long")
    want = defaultdict(set)
    for h, i in holds:
        want[h].add(i)
    want = sorted((h, max(d)) for h, d in want.items() if len(d) >= 3)
    for order in (range(9), range(8, -1, -1)):
        runs = line_dedup.LineRuns(spark)
        assert runs.repeated().count() == 0
        written = []
        for k in order:
            runs.add(lines.where(f"doc div 10 = {k}"))
            written.append([bool(level) for level in runs.levels])
        assert written[0] == [True] and written[5] == [False, True, True] and written[8] == [True, False, False, True]
        whole = spark.table(runs.levels[3])
        assert whole.count() == whole.select("hash").distinct().count() >= 39
        assert sorted((bytes(r.hash), r.top) for r in runs.repeated().collect()) == want
        assert runs.levels[:3] == [None] * 3
        runs.add(lines.where("doc < 9"))
        assert sorted(bytes(r.hash) for r in runs.repeated().select("hash").collect()) == [h for h, _ in want]
        runs.drop()
        assert not [t for t in spark.catalog.listTables() if t.name.startswith(runs.name)]


def test_runs_are_not_shuffled_again(spark):
    runs = line_dedup.LineRuns(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one, other = (runs._write(spark.range(k, k + 9).selectExpr("cast(cast(id as string) as binary) as hash", "1 as n", "id as top")) for k in (0, 5))
        batch = spark.range(9).selectExpr("cast(cast(id as string) as binary) as hash").groupBy("hash").count()
        for kind, left, shuffles in (("left_anti", batch, 1), ("full", spark.table(other), 0)):
            joined = left.join(spark.table(one), "hash", kind)
            joined.collect()
            plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
            assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == shuffles
        merged = spark.table(runs._merged(one, other))
        assert sorted((int(bytes(r.hash)), r.n, r.top) for r in merged.collect()) == [(i, 2 if 5 <= i < 9 else 1, i) for i in range(14)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        runs.drop()
