"""The stages on a small table, each against a plain Python version of its decision."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_near_copies import expected

from costlake.llm import langid, quality
from costlake.llm.scratch import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("kind", F.lit("x"))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], SF), name))
    return [{r["doc_id"]: r for r in s.collect()} for s in out[:-1]], out


def test_columns(steps):
    for frame in steps[1][1:-1]:
        assert frame.dtypes == steps[1][0].dtypes


def test_quality(steps):
    docs, frames = steps
    judged = quality.Judge(quality.references(frames[0]))([r["text"] for r in docs[0].values()])["kept"]
    assert set(docs[1]) == {k for k, kept in zip(docs[0], judged) if kept}
    assert all(docs[1][k] == docs[0][k] for k in docs[1])


def test_language(steps):
    docs, frames = steps
    predict = langid.Classifier(langid.train(frames[1])).predict
    assert set(docs[2]) == {k for k, r in docs[1].items() if predict(r["text"])[3]}
    assert len(docs[2]) > 0.95 * len(docs[1])


def test_near_duplicates(steps):
    """Against exact Jaccard similarity of all pairs of five-word shingle sets."""
    docs, _ = steps
    assert set(docs[3]) == expected({k: r["text"] for k, r in docs[2].items()})
    assert all(docs[3][k] == docs[2][k] for k in docs[3])
    texts = [r["text"] for r in docs[3].values()]
    assert len(set(texts)) == len(texts) < len(docs[2])


def test_rows_with_one_key_and_without(spark, steps):
    """Each text of a repeated key counts by itself, equal rows once; a row without a key stays if no row with one is its copy."""
    a, b, c = (r["text"] for r in list(steps[0][3].values())[:3])
    rows = [(1, a), (1, a), (1, b), (2, b), (3, a), (None, c), (None, c), (None, a), (None, None), (4, None), (5, "")]
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, _key string")
    got = corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == sorted([("1", a), ("1", b), ("None", c), ("4", "")])


def test_null_texts_pass_no_stage_that_judges(spark, steps):
    docs = steps[1][0].limit(80).union(steps[1][0].limit(3).withColumn("text", F.lit(None).cast("string")))
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF)
    assert docs.where("text is null").count() == 0 and docs.count() > 0
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, steps[1][0].limit(3).withColumn("text", F.lit(None).cast("string")), SF).count() > 0


def test_personal_data(steps):
    docs, _ = steps
    assert set(docs[4]) == set(docs[3])
    changed = [k for k in docs[4] if docs[4][k]["text"] != docs[3][k]["text"]]
    assert changed and all("<" in docs[4][k]["text"] and docs[4][k]["n_chars"] == len(docs[4][k]["text"]) for k in changed)
    assert not any("@mail" in r["text"] for r in docs[4].values())


def test_packing(steps):
    docs, frames = steps
    rows = frames[-1].collect()
    assert {r["doc_id"] for r in rows} == set(docs[4])
    assert all(len(r["ids"]) == r["length"] for r in rows)
    assert all(r["offset"] + r["length"] <= 2048 for r in rows)


def test_empty_and_clashing_columns(spark, steps):
    none = steps[1][0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SF)
        assert none.count() == 0
    odd = steps[1][0].limit(60).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("c")).withColumn("band", F.lit(2.0)).withColumn("_pii", F.lit("p"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, odd, SF)
        assert after.dtypes == odd.dtypes and after.count() > 0
