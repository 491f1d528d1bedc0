"""From documents to packed sequences: five stages, each written as Parquet and read again by the next.

1 quality: rows that fail the quality rules go.
2 language: rows whose language cannot be told go.
3 near_duplicates: of each group of near copies (0.8 or more of their five-word shingles in common) the row with the smallest doc_id stays.
4 personal_data: personal data in the texts are replaced by their kind.
5 packing: the texts as tokens, packed into sequences; one row per piece, with its ids, its sequence and its place there.

Defined cases are those of the operators: a null text fails the quality rules; of rows with one doc_id, each text counts by
itself; a null doc_id is no reason to go. An empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costlake.llm import langid, minhash, packing, pii, quality
from costlake.llm.scratch import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_clean(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one_of_each(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

#: No stage but the fourth can be said in SQL; tests/llm/test_pipeline.py holds the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
