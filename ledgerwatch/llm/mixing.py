"""Mix sources to target weights by Pareto order sampling.

A source's target gives each of its documents an expected number of copies. The whole
part is certain. The rest is an inclusion probability ``p``, and documents are taken in
order of ``(U / (1 - U)) / (p / (1 - p))``, with ``U`` uniform by a hash of id and text,
until the source has its words: a sample of fixed size with unequal probabilities.

The place where a source is cut is found from sums over intervals of the rank, twice as
fine each time they are refined 4096-fold, so a source of any size is only sorted in the
one interval that holds the cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.quality_rules import SPACE_PATTERN, SPACES
from ledgerwatch.workspace import stage, stage_counted

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
#: Up to so many sources, what is known of each is broadcast; beyond, its rows are dealt over ``SALTS`` tasks.
FEW_SOURCES = 20_000
SALTS = 32
#: Intervals of the rank that a step looks at.
BINS = 4096


def n_words(text: Column) -> Column:
    """Words of a text; null has none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, SPACE_PATTERN))).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts."""
    head = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("double")
    return (head + 0.5) / float(1 << 48)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``target``. One row per source, which are few by nature.

    Sources by code point, null last, get the weights in turn. Targets share ``share`` of all
    words by weight; none exceeds ``most`` times its source, and the excess goes to the others.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    everything = Window.partitionBy()
    out = sources.select("source", "source_size", weight.alias("weight"), (F.sum("source_size").over(everything) * share).alias("goal"))
    # The source with the least room per weight fills first; one that fills leaves its excess to those after it.
    limit = F.col("source_size") * float(most)
    room = [limit / F.col("weight"), F.col("source").asc_nulls_last()]
    before = Window.orderBy(*room).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*room).rowsBetween(0, Window.unboundedFollowing)
    left = F.col("goal") - F.coalesce(F.sum(limit).over(before), F.lit(0.0))
    out = out.select("*", (F.col("weight") * left / F.sum("weight").over(after) > limit).alias("full"))
    taken = F.sum(F.when(F.col("full"), limit).otherwise(0.0)).over(everything)
    free = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("full"), limit).otherwise(F.col("weight") * ((F.col("goal") - taken) / free))
    return out.select("source", "source_size", target.alias("target"))


def _beside(rows: DataFrame, facts: DataFrame, count: int, how: str = "inner", on: str = "true") -> DataFrame:
    """``rows`` as ``r`` joined to ``facts`` as ``f``, which has one row per source, so that a source of any size is in many tasks."""
    if count <= FEW_SOURCES:
        return rows.alias("r").join(F.broadcast(facts.alias("f")), F.expr(f"r.`from` <=> f.source and {on}"), how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id", "digest"), F.lit(SALTS)).cast("int"))
    facts = facts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.alias("r").join(facts.alias("f"), F.expr(f"r.`from` <=> f.source and r.salt = f.salt and {on}"), how)


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", preference: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES,
) -> DataFrame:
    """Plan of the mix: ``id``, ``digest`` (md5 of the text), ``from``, ``size``, ``source_size``, ``target``, ``copies``.

    ``preference`` (whole numbers from 1, default 1) makes a document's expected copies larger in
    proportion. Null is a source like any other, and comes last. Rows with equal id and
    text share one draw and are taken or left together. A source's last document is taken if
    that brings its words nearer to the target. Equal input gives equal results.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    drawn = docs.select(
        docs[id_col].alias("id"), F.md5(text).alias("digest"), docs[source_col].alias("from"),
        n_words(text).alias("size"), (preference if preference is not None else F.lit(1)).cast("long").alias("liked"),
    )
    drawn = drawn.withColumn("u", uniform(F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("digest")))
    drawn = stage(drawn, "mix-sizes")
    sums = drawn.groupBy(F.col("from").alias("source")).agg(F.sum("size").alias("source_size"), F.sum(F.col("size") * F.col("liked")).alias("liked_size"))
    sums = stage(sums, "mix-sources")
    plan = targets(sums.select("source", "source_size"), weights, share, most).alias("t").join(sums.alias("s"), F.expr("t.source <=> s.source"))
    plan, count = stage_counted(plan.select("t.source", "t.source_size", "target", F.when(F.col("liked_size") > 0, F.col("target") / F.col("liked_size")).otherwise(0.0).alias("rate")), "mix-targets")
    ranked = _beside(drawn, plan, count).select("r.id", "digest", "from", "size", "liked", "u", "source_size", "target", "rate")
    expected = F.least(F.lit(float(most)), F.col("rate") * F.col("liked"))
    ranked = ranked.withColumn("whole", F.floor(expected)).withColumn("p", expected - F.col("whole"))
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = ranked.withColumn("rank", F.when(F.col("p") > 0, odds / (1 + odds)))
    ranked = ranked.withColumn("bin", F.floor(F.col("rank") * BINS)).withColumn("fine", F.floor(F.col("rank") * BINS * BINS))
    whole = ranked.groupBy(F.col("from").alias("source")).agg((F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("want"))
    first = _crossing(ranked, whole, "bin")
    inside = _beside(ranked, first, count, on="r.bin = f.bin").select(*[f"r.{c}" for c in ranked.columns])
    second = _crossing(inside, first.select("source", F.col("left").alias("want")), "fine")
    last = _beside(inside, second, count, on="r.fine = f.fine").select("r.from", "r.rank", "r.size", "f.left")
    ties = last.groupBy("from", "rank").agg(F.sum("size").alias("size"), F.max("left").alias("left"))
    run = Window.partitionBy("from").orderBy("rank")
    ties = ties.select("*", F.sum("size").over(run).alias("upto"))
    # Nearer with than without; what lies before the cut's interval is taken anyway. Up to the
    # target that holds for a first run of ranks only, so an empty text beyond it moves no cut.
    good = ties.where(2 * F.col("upto") - F.col("size") <= 2 * F.col("left"))
    cut = good.groupBy(F.col("from").alias("source")).agg(F.max("rank").alias("cut"))
    edge = second.select("source", (F.col("fine") / float(BINS * BINS)).alias("edge")).alias("e").join(cut.alias("c"), F.expr("e.source <=> c.source"), "left")
    edge = edge.select("e.source", F.coalesce("cut", F.lit(-1.0)).alias("cut"), "edge")
    out = _beside(ranked, edge, count, "left")
    chosen = F.coalesce((F.col("rank") < F.col("edge")) | (F.col("rank") <= F.col("cut")), F.lit(False))
    return out.select("id", "digest", "from", "size", "source_size", "target", (F.col("whole") + chosen.cast("long")).alias("copies"))


def _crossing(ranked: DataFrame, want: DataFrame, step: str) -> DataFrame:
    """Per source, the interval ``step`` in which the wanted words are reached, and what is ``left`` to take in it."""
    sums = ranked.where(F.col(step).isNotNull()).groupBy("from", step).agg(F.sum("size").alias("size"))
    run = Window.partitionBy("from").orderBy(step)
    sums = sums.select("*", F.sum("size").over(run).alias("upto"), F.max(step).over(Window.partitionBy("from")).alias("end"))
    both = sums.alias("s").join(want.alias("w"), F.expr("s.`from` <=> w.source"))
    # If rounding asks for more than there is, the cut lies in the last interval.
    reach = both.where(F.expr(f"want > 0 and want > upto - size and (want <= upto or {step} = end)"))
    return reach.select("source", step, (F.col("want") - (F.col("upto") - F.col("size"))).alias("left"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    plan = mix(docs, id_col, text_col, source_col)
    plan = plan.groupBy("id", "digest", "from").agg(F.max("copies").alias("copies")).alias("p")
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.md5(text).alias("digest"), docs[source_col].alias("from")).alias("d")
    both = rows.join(plan, F.expr("d.id <=> p.id and d.digest = p.digest and d.`from` <=> p.`from`"))
    return both.where("copies > 0").select("row", F.explode(F.expr("sequence(1, copies)"))).select("row.*")
