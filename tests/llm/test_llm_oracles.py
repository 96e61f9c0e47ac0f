"""The queries that have SQL, against it."""

from __future__ import annotations

import pytest

from ledgerwatch.llm import queries
from testbed.compare import difference, open_oracle

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_agrees_with_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SMALL), open_oracle(SMALL), queries.ORACLES[name]) == ""


@pytest.mark.parametrize("name", ["op7_quality_rules", "op8_mixing", "op9_ngram_join", "op12_line_dedup"])
def test_awkward_rows_agree_with_sql(spark, name, tmp_path):
    """Null and empty texts and sources, equal texts, a size of zero, characters of several bytes."""
    texts = [None, "", " \n\t ", "a b c d", "a b c d", "A B C D", "é ü " * 30, "é ü " * 30, "one two\none two\n" * 9, "x " * 200]
    rows = [(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate((t, s) for s in (None, "", "Ö", "b", "a") for t in texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    assert difference(queries.QUERIES[name](spark, str(tmp_path)), open_oracle(str(tmp_path)), queries.ORACLES[name]) == ""
