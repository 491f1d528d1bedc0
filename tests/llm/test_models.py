"""Language identification by held-out accuracy, lattice scores against enumeration and plain Python."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlake.llm import langid, lattice

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " \n", "123 456 !!", "é", "漢字 😀 qzx", "the the THE", "the the THE", "x" * 30000, "The onou " * 8000]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    made = spark.createDataFrame([(100000 + i, t, None) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return real.unionByName(made).withColumn("word", F.lit("x")).withColumn("score", F.lit(3)).cache()


@pytest.fixture(scope="module")
def table(docs):
    return {r["doc_id"]: r for r in docs.collect()}


def test_language(docs, table):
    rows = {r["doc_id"]: r for r in langid.language_report(docs).collect()}
    assert rows.keys() == table.keys()
    for k, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
        letters = any(c.isalpha() for c in table[k]["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
    shuffled = docs.withColumn("lang", F.when(langid.held_out(F.col("doc_id"), 3, 1), "zz").otherwise(F.col("lang")))
    assert {r["doc_id"]: r["lang_pred"] for r in langid.language_report(shuffled).collect()} == {k: r["lang_pred"] for k, r in rows.items()}


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    both = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    right, accepted, total = both.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count_if("accepted"), F.count("*")).first()
    assert right >= 0.98 * total and accepted >= 0.98 * total


def test_repeated_texts_do_not_push_a_language_out(spark):
    """200,000 rows of 20 distinct texts beside 400 distinct texts of another language: both are learned."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang is not null")
    names = [r["lang"] for r in docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(2).collect()]
    few, many = (docs.where(F.col("lang") == n).select("lang", "text").dropDuplicates() for n in names)
    hot = few.limit(20).crossJoin(spark.range(10_000)).select("lang", "text")
    trained = langid.train(hot.union(many.limit(400)))
    assert sorted(name for name, _, _ in trained) == sorted(names)
    assert {name: n for name, n, _ in trained}[names[0]] == 20
    predict = langid.Classifier(trained).predict
    for name, frame in zip(names, (few, many)):
        texts = [r["text"] for r in frame.collect() if len(r["text"]) > 500]
        assert sum(predict(t)[0] == name for t in texts) > 0.95 * len(texts)


def test_training_reads_whole_texts(spark):
    """What only the ends of long texts hold is learned as well."""
    texts = [("x", "lorem ipsum " * 3000 + f"zweifelhafter{i} schwertfisch " * 3000) for i in range(5)] + [("y", "completely other words stand here " * 200)]
    trained = {name: content for name, _, content in langid.train(spark.createDataFrame(texts, "lang string, text string"))}
    assert b"schwertfisch" in trained["x"]


def test_prediction_against_plain_compression(docs, table):
    """The prediction is the language whose dictionary compresses the blocks of the whole text to the fewest bytes."""
    import zstandard

    trained = langid.train(docs.where(~langid.held_out(F.col("doc_id"), 3, 1)))
    rows = {r["doc_id"]: r for r in langid.language_report(docs).collect()}
    for k, r in table.items():
        text = r["text"] or ""
        if not any(c.isalpha() for c in text):
            continue
        raw = langid.letters(text).encode()
        sizes = []
        for _, _, content in trained:
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            c = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes.append(sum(len(c.compress(raw[i : i + langid.BLOCK_BYTES])) for i in range(0, len(raw), langid.BLOCK_BYTES)))
        assert rows[k]["lang_pred"] == trained[sizes.index(min(sizes))][0]


def test_language_edges(docs):
    assert langid.language_report(docs.limit(0)).count() == 0
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.language_report(none).collect()} == {"und"}
    twice = docs.where("doc_id < 30").union(docs.where("doc_id < 30"))
    assert langid.language_report(twice).count() == 60


def path():
    import public_tokenizers

    return public_tokenizers.path(lattice.VOCABULARY)


def segmentations(word, v):
    if not word:
        yield []
    for end in range(1, len(word) + 1):
        if word[:end] in v.pieces:
            first = [v.pieces[word[:end]]]
        elif end == 1:
            first = [v.bytes[b] for b in word[0].encode()]
        else:
            continue
        for rest in segmentations(word[end:], v):
            yield first + rest


def test_lattice_sums_all_segmentations():
    v = lattice.Vocabulary(path())
    model = lattice.Lattice(v, v.start_values)
    assert abs(v.start_values.sum() - 1) < 1e-9
    words = ["▁the", "▁thing", "▁é漢x", "▁nation", "▁q", "▁", "▁stäre"]
    got = model.log_probabilities(words)
    expected = np.zeros(len(v.start_values))
    for word, log in zip(words, got):
        paths = list(segmentations(word, v))
        weights = [math.prod(v.start_values[i] for i in p) for p in paths]
        assert math.isclose(log, math.log(sum(weights)), rel_tol=1e-9)
        for p, w in zip(paths, weights):
            for i in p:
                expected[i] += 3 * w / sum(weights)
    assert np.allclose(model.expected(words, np.full(len(words), 3.0)), expected)


def test_scores(docs, table, monkeypatch):
    monkeypatch.setattr(lattice, "HOT", 200)  # so that most words are joined
    rows = {r["doc_id"]: r for r in lattice.score(docs).collect()}
    assert rows.keys() == table.keys()
    words = {k: [*(r["text"] or "").encode().lower().split(), None] for k, r in table.items()}
    learned = {k for k in table if zlib.crc32(str(k).encode()) % 7 != 2}
    counts = Counter(w for k in learned for w in words[k])
    n, v = sum(counts.values()), len(counts)
    vocabulary = lattice.Vocabulary(path())
    trained = [(w, c) for w, c in counts.items() if w is not None]
    first = lattice.Lattice(vocabulary, vocabulary.start_values)
    pieces, times = ["▁" + w.decode() for w, _ in trained], np.array([float(c) for _, c in trained])
    shares = vocabulary.start_values
    for _ in range(lattice.ROUNDS):
        shares = lattice.PRIOR * vocabulary.start_values + lattice.Lattice(vocabulary, shares).expected(pieces, times)
        shares[vocabulary.end] += counts[None]
        shares /= shares.sum()
    model = lattice.Lattice(vocabulary, shares)
    distinct = sorted({w for ws in words.values() for w in ws if w is not None})
    logs = dict(zip(distinct, model.log_probabilities(["▁" + w.decode() for w in distinct]) / math.log(10)))
    logs[None] = math.log10(shares[vocabulary.end])
    for k, ws in words.items():
        r = rows[k]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (k not in learned, len(ws), n)
        assert r["n_known"] == sum(counts[w] > 0 for w in ws)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert math.isclose(r["score"], sum(logs[w] for w in ws), rel_tol=1e-9)
    apart = [r for k, r in rows.items() if r["held_out"]]
    untrained = dict(zip(distinct, first.log_probabilities(["▁" + w.decode() for w in distinct]) / math.log(10)))
    assert sum(r["score"] for r in apart) > 0.9 * sum(untrained.get(w, 0.0) for k, r in rows.items() if r["held_out"] for w in words[k])


def test_lattice_edges(docs):
    assert lattice.score(docs.limit(0)).count() == 0
    twice = docs.where("doc_id < 30").union(docs.where("doc_id < 30"))
    rows = lattice.score(twice).collect()
    assert len(rows) == 60 and len({(r["doc_id"], r["n_tokens"], r["n_known"]) for r in rows}) == 30
