"""The language of clean texts must be told whatever their length."""

import random

import pytest

from costlake.llm import langid

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def languages(spark):
    """Texts of each language, and dictionaries learned from them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null")
    texts = {}
    for r in docs.select("lang", "text").orderBy("doc_id").collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    return texts, langid.train(docs)


@pytest.mark.parametrize("dictionary", [langid.DICTIONARY_BYTES, langid.MIN_EVEN_BYTES])
@pytest.mark.parametrize("size", [20_000, 600_000, 2_000_000])
def test_long_clean_texts(languages, dictionary, size):
    texts, trained = languages
    predict = langid.Classifier([(name, n, content[:dictionary]) for name, n, content in trained]).predict
    rng = random.Random(3)
    for lang, own in texts.items():
        text = " ".join(own)
        while len(text) < size:
            words = text.split()
            rng.shuffle(words)
            text += " " + " ".join(words)
        name, _, lead, accepted = predict(text[:size])
        assert (name, accepted) == (lang, True), (lang, size, name, lead)


def test_mixed_long_text_has_no_language(languages):
    """Equal parts of two languages, alternating: neither leads."""
    texts, trained = languages
    predict = langid.Classifier(trained).predict
    a, b = (sorted(texts, key=lambda x: -len(texts[x]))[i] for i in (0, 1))
    mixed = " ".join(f"{x} {y}" for x, y in zip(" ".join(texts[a]).split()[:100_000], " ".join(texts[b]).split()[:100_000]))
    one = " ".join(" ".join(texts[a]).split()[:100_000])
    assert predict(mixed)[2] < predict(one)[2]
