"""Null keys, null and short texts alone, and clashing columns: every report gives a row per document and does not fail."""

import pytest
from pyspark.sql import functions as F

from costlake.llm import queries


#: Those that read other tables have edge tests of their own.
REPORTS = {n: f for n, f in queries.queries().items() if n not in ("op11_conversation_trie", "op13_hard_negatives")}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables of null keys and texts only, and of short texts with repeated keys and further columns."""
    root = tmp_path_factory.mktemp("edges")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(None, None, None, None, None)] * 3, schema).write.parquet(f"{root}/nulls/documents.parquet")
    rows = [(1, "a b", "en", None, 3), (1, "a b", "en", None, 3), (1, "c", None, "s", 1), (None, "d e f", "fr", "s", 5), (2, "", "en", "s", 0), (3, None, "en", "s", None)]
    more = spark.createDataFrame(rows, schema)
    for name in ("fp", "word", "kind", "start", "score", "_range", "_pii", "length", "label"):
        more = more.withColumn(name, F.lit("x"))
    more.write.parquet(f"{root}/short/documents.parquet")
    return str(root)


@pytest.mark.parametrize("name", REPORTS)
def test_reports(spark, folder, name):
    for table, count in (("nulls", 3), ("short", 6)):
        got = REPORTS[name](spark, f"{folder}/{table}").collect()
        assert len(got) == count, (name, table)
        keys = sorted(str(r["doc_id"]) for r in got)
        assert keys == (["None"] * 3 if table == "nulls" else ["1", "1", "1", "2", "3", "None"])
