"""Document rules, and host verdicts shrunk by an empirical beta prior. Column functions only.

A document's words, repeated lines and repeated word windows are counted inside its
row, so nothing is exploded or shuffled. Failures are then summed by host. Hosts differ
in size, so a raw rate of a small host says little: the rates of all hosts give a beta
prior by their mean and variance, and a host's rate is taken with the prior's counts
added. Hosts above ``HOST_LIMIT`` are rejected, and all their documents with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.workspace import stage

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
#: A host whose shrunken failure rate is above this is rejected.
HOST_LIMIT = 0.6
#: Documents that the prior counts for at most, also where all hosts have one rate.
MAX_PRIOR = 1e6

SPACES = " \t\n\x0b\f\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_PATTERN), lambda w: w != "")


def rule_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) with the counts and ``base_failed``. A null text has no words."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    without = lambda characters: F.char_length(text) - F.char_length(F.translate(text, characters, ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    out = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        words(text).alias("w"),
        lines.alias("lines"),
        F.char_length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("w") - WINDOW),
        lambda i: F.xxhash64(*[F.get("w", i + k) for k in range(WINDOW)]),
    )
    out = out.select(
        "row", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, windows).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # Few documents have a repeated window; only theirs are put in order.
    placed = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct("h")) < F.size("h")
    out = out.select("*", F.when(some, placed).alias("placed")).drop("h")
    twice = F.filter("placed", lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]))
    out = out.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("at")).drop("placed")
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, b: a + b,
    )
    out = out.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("at")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.select("row", *COUNTS[:-1], failed.alias("base_failed"))


def host_verdicts(counted: DataFrame, host: Column) -> DataFrame:
    """``host``, ``host_docs``, ``host_rate`` and ``host_kept``; null is a host like any other.

    ``counted`` has ``base_failed``. Only one row of sums over the hosts comes to the driver.
    """
    hosts = counted.groupBy(host.alias("host")).agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(F.col("base_failed").cast("long")).alias("failed")
    )
    hosts = stage(hosts, "hosts")
    rate = F.col("failed") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg(1 / F.col("host_docs")).alias("inverse")).first()
    mean = prior["m"] or 0.0
    # What the hosts' rates differ by beyond the chance of their sizes.
    spread = max((prior["v"] or 0.0) - mean * (1 - mean) * (prior["inverse"] or 0.0), 0.0)
    strength = min(mean * (1 - mean) / spread - 1, MAX_PRIOR) if spread > 0 else MAX_PRIOR
    strength = max(strength, 1.0)
    shrunken = (F.col("failed") + mean * strength) / (F.col("host_docs") + strength)
    return hosts.select("host", "host_docs", shrunken.alias("host_rate"), (shrunken <= HOST_LIMIT).alias("host_kept"))


def judge(counted: DataFrame, host: Column) -> DataFrame:
    """``counted`` with ``host_rate`` and ``kept``."""
    verdicts = host_verdicts(counted, host)
    joined = counted.join(verdicts, host.eqNullSafe(verdicts["host"]), "left")
    return joined.select(*[counted[c] for c in counted.columns], "host_rate", (~F.col("base_failed") & F.col("host_kept")).alias("kept"))


def rule_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, counts, ``base_failed``, ``host_rate`` and ``kept``.

    The counts are written once, without texts, and read for the hosts and for the result.
    Null texts are empty and fail; a null id is kept as it is; repeated rows count each.
    """
    counted = rule_counts(docs, text_col).select(
        F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{host_col}`").alias("from"), *COUNTS
    )
    counted = stage(counted, "rule-counts")
    return judge(counted, F.col("from"))


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    counted = rule_counts(docs, text_col)
    light = counted.select(F.col(f"row.`{host_col}`").alias("from"), "base_failed")
    verdicts = host_verdicts(light, F.col("from")).where("host_kept")
    # A filter on what a row's own projections compute would be pushed below them and have every
    # step written into it, so it also asks for a column that has no value before them.
    good = counted.select("*", F.monotonically_increasing_id().alias("place"))
    good = good.where(~F.col("base_failed") & (F.col("place") >= 0))
    good = good.join(verdicts, good[f"row.`{host_col}`"].eqNullSafe(verdicts["host"]), "left_semi")
    return good.select("row.*")
