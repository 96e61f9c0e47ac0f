"""Line dedup against levelled sorted runs of line hashes, with column functions only.

A run is a table of line hashes, bucketed and sorted by the hash, with how many documents
hold each (counted up to the number that makes a line repeated) and the largest of their
ids. Documents come in batches. A batch's hashes are reduced to one row each, shuffled once
into the runs' buckets, and merge-anti-joined with run after run, which stay where they
are: a hash that a run knows as repeated, with an id as large, adds nothing and leaves. The rest
becomes a run of its own on level 0. Two runs of a level are merged into one of the next, by
an outer join of their buckets without a shuffle, so there is at most one run a level and each
hash is rewritten once a level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerwatch.workspace import delete_folder, new_folder, stage

#: Documents that make a line repeated, and code points that its key has at least.
DOCUMENTS, CHARACTERS = 3, 20
#: Batches that :func:`without_repeated_lines` cuts a whole table into, by ranges of the id.
BATCHES = 6
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What a null id counts as: one document, before all others.
FIRST = -(2**63)


class LineRuns:
    """Levelled runs of line hashes (``hash``, ``n``, ``top``) in the shared folder.

    The documents of one id must all come in one batch. Batches may come in any order and give the
    same :meth:`repeated`; with the largest ids first, most hashes of later batches leave early.
    """

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS):
        self.spark, self.documents = spark, documents
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.folder, self.name = new_folder(spark, "lines"), f"line_runs_{uuid.uuid4().hex}"
        #: The run of each level, if it has one.
        self.levels: list[str | None] = []
        self.made = 0

    def _write(self, run: DataFrame) -> str:
        name = f"{self.name}_{self.made}"
        self.made += 1
        bucketed = run.select("hash", "n", "top").write.bucketBy(self.buckets, "hash").sortBy("hash")
        bucketed.format("parquet").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _drop(self, *names: str) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            delete_folder(self.spark, f"{self.folder}/{name}")

    def _merged(self, one: str, other: str) -> str:
        # Not a union: Spark 4.1 takes a union of bucketed scans as bucketed although it isn't.
        a, b = (self.spark.table(name).alias(side) for name, side in ((one, "a"), (other, "b")))
        count = F.expr(f"cast(least(coalesce(a.n, 0) + coalesce(b.n, 0), {self.documents}) as int)")
        both = a.join(b, F.expr("a.hash = b.hash"), "full")
        name = self._write(both.select(F.expr("coalesce(a.hash, b.hash)").alias("hash"), count.alias("n"), F.greatest("a.top", "b.top").alias("top")))
        self._drop(one, other)
        return name

    def _place(self, run: str) -> None:
        level = 0
        while level < len(self.levels) and self.levels[level]:
            run, self.levels[level] = self._merged(self.levels[level], run), None
            level += 1
        self.levels[level : level + 1] = [run]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of lines (``hash``, ``doc``); a document may hold a hash several times."""
        count = F.least(F.count(F.lit(1)), F.lit(self.documents)).cast("int")
        # Distinct pairs first: a line that all documents hold is spread over them, then summed where it is.
        batch = lines.select("hash", "doc").distinct().groupBy("hash").agg(count.alias("n"), F.max("doc").alias("top"))
        for name in filter(None, reversed(self.levels)):
            run = self.spark.table(name).where(F.col("n") >= self.documents).alias("run")
            known = F.expr("run.hash = batch.hash and run.top >= batch.top")
            batch = batch.alias("batch").join(run, known, "left_anti").select("hash", "n", "top")
        self._place(self._write(batch))

    def repeated(self) -> DataFrame:
        """``hash`` and ``top``, the largest id that holds it, of all repeated lines so far. Merges the runs into one."""
        names = list(filter(None, self.levels))
        if not names:
            return self.spark.createDataFrame([], "hash binary, top long")
        whole = names[0]
        for name in names[1:]:
            whole = self._merged(name, whole)
        self.levels = [*[None] * (len(self.levels) - 1), whole]
        # As files, not as a bucketed table: a join that shuffles both sides can split a hash that very many lines have.
        run = self.spark.read.schema("hash binary, n int, top long").parquet(f"{self.folder}/{whole}")
        return run.where(F.col("n") >= self.documents).select("hash", "top")

    def drop(self) -> None:
        """Delete all runs."""
        self._drop(*filter(None, self.levels))
        self.levels = []
        delete_folder(self.spark, self.folder)


def key_of(line: Column) -> Column:
    """The line without white space at both ends, A-Z as a-z."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, characters: int = CHARACTERS) -> DataFrame:
    """``doc``, ``twin`` (tells texts of one id apart), ``pos`` and ``hash`` of every line whose key is long enough."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    keys = F.transform(F.split(text, "\n", -1), key_of)
    lines = docs.select(_document(docs[id_col]).alias("doc"), F.xxhash64(text).alias("twin"), F.posexplode(keys).alias("pos", "key"))
    return lines.where(F.char_length("key") >= characters).select("doc", "twin", "pos", F.unhex(F.md5("key")).alias("hash"))


def _document(column: Column) -> Column:
    return F.coalesce(column.cast("long"), F.lit(FIRST).cast("long"))


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = DOCUMENTS, characters: int = CHARACTERS, batches: int = BATCHES
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (without the text), with ``text``, ``n_lines`` and ``n_dropped``.

    Lines end at ``\\n``; a null or empty text is one empty line. A line whose key has at least
    ``characters`` code points and is found in at least ``documents`` ids goes from all of
    them but the largest, also where that one holds it several times. ``text`` is what is left, joined by ``\\n`` (empty, not null, if nothing is);
    ``n_lines`` counts before dropping. Rows of one id are one document: repeated rows don't make a line repeated,
    and a null id is one document smaller than all others. Other columns may have any names.
    """
    spark = docs.sparkSession
    cuts = docs.agg(F.percentile_approx(_document(docs[id_col]), [k / batches for k in range(1, batches)], 10_000)).first()[0] or []
    cuts = sorted(set(cuts))
    folder = new_folder(spark, "line-hashes")
    lines = line_hashes(docs, id_col, text_col, characters)
    batch = sum((F.when(F.col("doc") > cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    lines.withColumn("batch", batch.cast("int")).write.partitionBy("batch").parquet(folder)
    lines = spark.read.schema("doc long, twin long, pos int, hash binary, batch int").parquet(folder)
    runs = LineRuns(spark, documents)
    for number in range(len(cuts), -1, -1):
        runs.add(lines.where(F.col("batch") == number))
    # A line that very many documents hold is split by the join, and its positions are gathered by document.
    found = lines.join(runs.repeated(), "hash").where("doc <> top")
    found = stage(found.groupBy("doc", "twin").agg(F.array_sort(F.collect_set("pos")).alias("gone")), "cut-lines")
    runs.drop()
    delete_folder(spark, folder)

    others = [docs[c] for c in docs.columns if c != text_col]
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    given = docs.select(F.struct(F.lit(0).alias("_"), *others).alias("row"), _document(docs[id_col]).alias("own"), text.alias("text"))
    # Never a broadcast: Spark would choose it by the size of the files, and places that many documents share take next to nothing there.
    both = given.withColumn("own_twin", F.xxhash64("text")).join(found.hint("merge"), F.expr("own = doc and own_twin = twin"), "left")
    parts = F.split("text", "\n", -1)
    # What is kept lies between the dropped places.
    kept = F.expr(
        "flatten(transform(sequence(0, size(gone)), k -> slice(parts, edges[k] + 2, edges[k + 1] - edges[k] - 1)))"
    )
    edges = F.concat(F.array(F.lit(-1)), F.col("gone"), F.array(F.size("parts")))
    both = both.select("row", "text", "gone", parts.alias("parts")).select("row", "text", "gone", "parts", edges.alias("edges"))
    return both.select(
        "row",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("parts").cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    )
