"""Quality rules and fingerprints against brute force."""

import hashlib
import math
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from costlake.llm import fingerprints, quality

SF = "/root/testdata/sf0.001"
TEXTS = [
    None,
    "",
    " \n\n\t",
    "a b c a b c a b c d",
    "x\x1cy z\x85w " * 60,
    "line one here\nline one here\n\nline  one here\n" * 20,
    "# * $ % & | < > " * 80,
    "漢字 😀 é " * 5000,
    "q" * 50000,
    "same text of two documents",
    "same text of two documents",
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    made = spark.createDataFrame([(100000 + 7 * i, t, None) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string")
    return real.unionByName(made).withColumn("word", F.lit("x")).withColumn("_range", F.lit(3)).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.collect()}


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 4000 else {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in many for j in (i, i + 1, i + 2)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_quality_counts(docs, texts):
    rows = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert rows.keys() == texts.keys()
    for k, text in texts.items():
        r = rows[k]
        want = counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, text[:80]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
        assert (r["char_distance"] is not None) == (len(text) >= quality.MIN_CHARS)
        assert (r["word_distance"] is not None) == (want[0] >= quality.MIN_WORDS)
    good = [r for r in rows.values() if r["doc_id"] < 100000 and not r["base_failed"]]
    assert sum(r["kept"] for r in good) > 0.9 * len(good)


def test_kept_is_recomputed(docs, texts):
    """The verdict from distances in plain Python: nearest language by each histogram, left out where a text is short."""
    known = quality.references(docs)
    table = {0: "lower", 1: "upper", 2: "letter", 3: "mark", 5: "space", 6: "newline", 7: "punctuation", 8: "symbol", 9: "other"}

    def distance(p, q):
        total = 0.0
        for a, b in zip(p, q):
            m = (a + b) / 2
            total += (a * math.log2(a / m) if a else 0) / 2 + (b * math.log2(b / m) if b else 0) / 2
        return math.sqrt(max(0.0, total))

    for r in quality.judge(docs).collect():
        text = texts[r["doc_id"]]
        words = text.encode().lower().split()
        classes = Counter()
        for c in text:
            kind = unicodedata.category(c)
            at = 6 if c == "\n" else 5 if c == "\t" else {"Ll": 0, "Lu": 1}.get(kind, {"L": 2, "M": 3, "N": 4, "Z": 5, "P": 7, "S": 8}.get(kind[0], 9))
            classes[at] += at in table
        chars, tally = sum(classes.values()), Counter(words)
        want = not r["base_failed"]
        if chars >= quality.MIN_CHARS:
            near = min(distance([classes[i] / chars for i in range(10)], ref["classes"]) for ref in known)
            assert math.isclose(near, r["char_distance"], abs_tol=1e-6)
            want &= r["char_distance"] <= quality.MAX_CHAR_DISTANCE
        if len(words) >= quality.MIN_WORDS:
            near = []
            for ref in known:
                own = [tally[w] / len(words) for w in ref["words"]]
                near.append(distance([*own, 1 - sum(own)], ref["shares"]))
            assert math.isclose(min(near), r["word_distance"], abs_tol=1e-6)
            want &= r["word_distance"] <= quality.MAX_WORD_DISTANCE
        assert r["kept"] == want


def test_long_words_are_counted_by_digest(spark):
    text = " ".join(["w" * 5000] * 300 + [f"a{i}" for i in range(900)])
    docs = spark.createDataFrame([(1, text, "x"), (2, text, "x")], "doc_id long, text string, lang string")
    (ref,) = quality.references(docs)
    assert len(ref["words"][0]) == 17 and math.isclose(ref["shares"][0], 0.25)
    assert quality.Judge([ref])([text])["word_distance"][0] < 0.3


def test_references_are_exact(docs, texts):
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    for ref in quality.references(docs, 30):
        words = [w for k, t in texts.items() if langs[k] == ref["lang"] for w in t.encode().lower().split()]
        tally = Counter(words)
        top = sorted(tally.items(), key=lambda x: (-x[1], x[0]))[:30]
        assert ref["words"] == [w for w, _ in top]
        assert np.allclose(ref["shares"], [n / len(words) for _, n in top] + [1 - sum(n for _, n in top) / len(words)])


def test_js_distance():
    p = np.array([[1.0, 0.0], [0.5, 0.5], [0.0, 1.0]])
    assert np.allclose(quality.js_distance(p, np.array([1.0, 0.0])), [0, 0.5579230452841438, 1])


def plain_chunks(data, table):
    """Byte by byte, the hash begun anew in each chunk."""
    out, start = {}, 0
    while start < len(data):
        h, cut = 0, min(len(data), start + fingerprints.MOST)
        for at in range(start, cut):
            h = (h * 2 + int(table[data[at]])) & 0xFFFFFFFF
            size = at + 1 - start
            bits = fingerprints.HARD_BITS if size <= fingerprints.NORMAL else fingerprints.EASY_BITS
            if size >= fingerprints.LEAST and h >> (32 - bits) == 0 and at + 1 < cut and data[at + 1] & 0xC0 != 0x80:
                cut = at + 1
                break
        if cut < len(data):
            while cut > start + 1 and data[cut] & 0xC0 == 0x80:
                cut -= 1
        out[xxhash.xxh32_intdigest(data[start:cut])] = cut - start
        start = cut
    return out


@pytest.mark.parametrize("partitions", [1, 5])
def test_fingerprints(spark, docs, texts, partitions):
    table = fingerprints.gear_table()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    rows = {r["doc_id"]: r for r in fingerprints.fingerprint_report(docs).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows.keys() == texts.keys()
    order = sorted(texts, reverse=True)
    for k, after in zip(order, [*order[1:], order[0]]):
        text, other, r = texts[k], texts[after], rows[k]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        a, b, c = (plain_chunks(t.encode(), table) for t in (text, edited, other))
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.as_string(a)
        assert r["edited_fingerprint"] == fingerprints.as_string(b)
        assert r["near_edited"] == fingerprints.containment(a, b) and r["near_next"] == fingerprints.containment(a, c)


def test_chunks_survive_shifts():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(3000)]
    text = " ".join(words)
    moved = "an inserted sentence " + text[:5000] + text[5100:]
    a, b = fingerprints.chunk_sets([text.encode(), moved.encode()], fingerprints.gear_table())
    assert fingerprints.containment(a, b) > 0.95


def test_repeated_keys_and_empty(spark, docs):
    twice = docs.where("doc_id < 30").union(docs.where("doc_id < 30"))
    assert fingerprints.fingerprint_report(twice).count() == quality.judge(twice).count() == 60
    one = docs.where("doc_id = 5")
    assert fingerprints.fingerprint_report(one).first()["near_next"] == 1.0
    none = docs.limit(0)
    assert fingerprints.fingerprint_report(none).count() == quality.judge(none).count() == 0
