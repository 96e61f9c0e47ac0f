"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import (
    alignment, cap_filters, html_extraction, line_dedup, lookup_sharding, mixing, ngram_join, oracles, quality_rules, ranked_search, sentencepiece_codec, suffix_dedup, toxicity, warc,
)

PIECES, BYTES = "piece_bpe_32k.model", "byte_bpe_50k.json"


def model_path(name: str = PIECES) -> str:
    """Place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def workers_import(spark: SparkSession) -> SparkSession:
    """Let Python workers of this session import the package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return workers_import(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    files = warc.write_archives(pages, warc.archive_folder(spark))
    return warc.read_archives(files, with_payload=False).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.main_text(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "row.doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return lookup_sharding.assign(docs, docs["doc_id"]).select("row.doc_id", "slot", "shard")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode_documents(docs, model_path()).select(
        "row.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_rules.rule_verdicts(table(spark, sf_dir, "documents"))
    return verdicts.select(F.col("id").alias("doc_id"), *quality_rules.COUNTS, "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf_dir, "documents"))
    taken = F.col("copies") * F.col("size")
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken.alias("taken"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id")


def op10_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cap_filters.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = alignment.linked_counts(docs, model_path(BYTES), model_path(PIECES))
    return found.select("row.doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_html_extraction": op2_html_extraction,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_sharding": op4_sharding,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_ngram_join": op9_ngram_join,
    "op10_cap_filters": op10_cap_filters,
    "op11_ranked_search": op11_ranked_search,
    "op12_line_dedup": op12_line_dedup,
    "op13_alignment": op13_alignment,
}
#: The queries that SQL can express.
ORACLES: dict[str, str] = oracles.ORACLES
