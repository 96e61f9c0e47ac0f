"""A training corpus from ``documents``: five operators, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.llm import mixing, ngram_join, quality_rules, sentencepiece_codec, suffix_dedup
from ledgerwatch.llm.queries import model_path, table, workers_import
from ledgerwatch.workspace import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and their host's verdict keep.

    Null and empty texts have no words and go. Rows are judged one by one, so repeated rows, also
    with one id, stay or go alike; rows without source are a host of their own.
    """
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id.

    Rows that share this id all stay, and so do rows without id, since none of them can be
    told to be the smallest. Texts without words are in no group.
    """
    workers_import(spark)
    return ngram_join.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings of earlier documents.

    Cuts are by bytes; what is left of a character that was cut through is dropped.
    Replacement characters of the documents themselves stay.
    """
    workers_import(spark)
    out = suffix_dedup.remove_repeats(docs, characters=True)
    text = F.make_valid_utf8(F.col("kept").cast("string"))
    row = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    out = out.select(*row, text.alias("text"))
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, twice at most.

    Reruns take the same rows. Rows without source are a source, the last one. Repeated rows
    are drawn together, since nothing tells them apart.
    """
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, where each piece's bytes end, and the number of pieces."""
    workers_import(spark)
    out = sentencepiece_codec.encode_documents(docs.select("doc_id", "source", "text"), model_path())
    return out.select("row.doc_id", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("end").alias("ends"))


STAGES = [
    ("quality rules", quality),
    ("n-gram jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources", source_mix),
    ("sentencepiece", pieces),
]

#: Shards and their merge, and the pieces of a tokenizer, have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: a row of piece ids for each copy that the mix takes.

    Every stage but the last is written and read again. Stages carry whatever further columns the
    table has, whatever their names; a table without rows gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
