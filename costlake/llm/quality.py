"""Quality rules: counts of the whole text, and divergence from references of its language.

References are gathered from all documents with a language: the shares of character
classes and of the COMMON most frequent words. A document's two histograms are compared
with every reference by Jensen-Shannon distance (base 2, so 0 to 1); the nearest language
counts, so that a wrong or missing label rejects nothing. Short texts have noisy
histograms: below MIN_CHARS or MIN_WORDS that comparison is left out.

The corpus pass counts words a task at a time and sums the counts in one shuffle; only
the references, a few hundred rows a language, reach the driver.

Defined cases: a null text counts as empty, has no words and fails; a very long text is
counted whole, as one of few in its slice; words equally frequent are ranked by their
bytes; repeated rows are judged each for itself; documents without a language take no part
in references but are judged; a language of fewer than MIN_REFERENCE_WORDS words in all
gives no reference, as its shares would be noise; without any reference only the base
rules hold; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import filter_slices, map_slices, ship, slices

COMMON = 200
MIN_CHARS, MIN_WORDS, MIN_REFERENCE_WORDS = 250, 100, 1000
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.14, 0.52
#: Distinct words a task holds before it hands on its counts; bytes from which a word is counted by its digest.
HELD_WORDS, LONG_WORD = 400_000, 64
CLASSES = ("lower", "upper", "letter", "mark", "number", "space", "newline", "punctuation", "symbol", "other")
# White space between words, and symbols.
SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


@cache
def class_table() -> np.ndarray:
    """Class of each code point of the basic plane, by general category; others count with letters from 0x20000 on, else as symbols."""
    kinds = {"Ll": 0, "Lu": 1, "L": 2, "M": 3, "N": 4, "Z": 5, "P": 7, "S": 8}
    table = np.full(0x10000, 9, dtype=np.int64)
    for code in range(0x10000):
        category = unicodedata.category(chr(code))
        table[code] = kinds.get(category, kinds.get(category[0], 9))
    table[ord("\n")], table[ord("\t")] = 6, 5
    return table


def class_counts(text: str) -> np.ndarray:
    """Characters of each class but numbers: identifiers, prices and telephone numbers say little about quality."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    high = codes >= 0x10000
    counts = np.bincount(class_table()[codes[~high] if high.any() else codes], minlength=len(CLASSES))
    if high.any():
        beyond = int((codes >= 0x20000).sum())
        counts[2] += beyond
        counts[8] += int(high.sum()) - beyond
    counts[4] = 0
    return counts


def base_counts(text: str, raw: bytes, words: list[bytes]) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [x for x in raw.split(b"\n") if x.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        reach = 0  # words before it are counted or passed
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(i, reach)
                reach = i + 3
    return (
        len(words),
        len(text) - sum(raw.count(c) for c in SPACES),
        sum(raw.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated,
    )


def term(word: bytes) -> bytes:
    """What a word is counted as: itself, or a digest if it is long, so that references are bounded in bytes."""
    return word if len(word) <= LONG_WORD else b"\0" + blake2b(word, digest_size=16).digest()


def _corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, class, n) of a task's documents, whose columns are lang, text; the class after the last counts all words."""
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        rows = [(lang, term(w), n) for lang, counts in words.items() for w, n in counts.items()]
        words.clear()
        langs, found, numbers = zip(*rows) if rows else ((), (), ())
        nothing = pa.array([None] * len(rows), pa.int32())
        return pa.RecordBatch.from_pydict(
            {"lang": pa.array(langs, pa.string()), "word": pa.array(found, pa.binary()), "class": nothing, "n": pa.array(numbers, pa.int64())}
        )

    for batch in batches:
        for part in slices(batch):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text:
                    found = text.encode().lower().split()
                    words.setdefault(lang, Counter()).update(found)
                    classes[lang] = classes.get(lang, 0) + np.append(class_counts(text), len(found))
            if sum(map(len, words.values())) > HELD_WORDS:
                yield flush()
    yield flush()
    rows = [(lang, k, int(n)) for lang, counts in classes.items() for k, n in enumerate(counts)]
    langs, kinds, numbers = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_pydict(
        {
            "lang": pa.array(langs, pa.string()),
            "word": pa.array([None] * len(rows), pa.binary()),
            "class": pa.array(kinds, pa.int32()),
            "n": pa.array(numbers, pa.int64()),
        }
    )


def references(docs: DataFrame, common: int = COMMON) -> list[dict]:
    """For each language: lang, classes (shares), words (common words), shares (of these, then of all others)."""
    ship(docs.sparkSession)
    counted = (
        docs.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_corpus_counts, "lang string, word binary, class int, n long")
        .groupBy("lang", "word", "class")
        .agg(F.sum("n").alias("n"))
    )
    ranked = counted.withColumn("_rank", F.row_number().over(W.partitionBy("lang", F.isnull("word")).orderBy(F.desc("n"), "word")))
    rows = ranked.where(F.col("_rank") <= max(common, len(CLASSES) + 1)).drop("_rank").collect()
    found = []
    for lang in sorted({r["lang"] for r in rows}):
        own = [r for r in rows if r["lang"] == lang]
        by_class = np.zeros(len(CLASSES) + 1)
        for r in own:
            if r["class"] is not None:
                by_class[r["class"]] = r["n"]
        total, by_class = int(by_class[-1]), by_class[:-1]
        if total < MIN_REFERENCE_WORDS:
            continue
        words = sorted(((r["n"], bytes(r["word"])) for r in own if r["word"] is not None), key=lambda x: (-x[0], x[1]))[:common]
        shares = np.array([n for n, _ in words] + [total - sum(n for n, _ in words)]) / total
        found.append({"lang": lang, "classes": by_class / by_class.sum(), "words": [w for _, w in words], "shares": shares})
    return found


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of p from q."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(axis=1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(axis=1)
    return np.sqrt(np.clip((a + b) / 2, 0.0, 1.0))


class Judge:
    def __init__(self, known: list[dict]):
        self.known = known
        self.union = sorted({w for r in known for w in r["words"]})
        place = {w: i for i, w in enumerate(self.union)}
        self.own = [np.array([place[w] for w in r["words"]], dtype=np.int64) for r in known]
        self.digested = any(w[:1] == b"\0" for w in self.union)

    def __call__(self, texts: list[str | None]) -> dict[str, list]:
        base, classes, words = [], np.zeros((len(texts), len(CLASSES))), np.zeros((len(texts), len(self.union)))
        for i, text in enumerate(texts):
            text = text or ""
            raw = text.encode()
            found = raw.split()
            base.append(base_counts(text, raw, found))
            if self.known and text:
                classes[i] = class_counts(text)
                counts = Counter(raw.lower().split())
                if self.digested:
                    counts.update({term(w): n for w, n in counts.items() if len(w) > LONG_WORD})
                words[i] = [counts.get(w, 0) for w in self.union]
        n = np.array([b[0] for b in base], dtype=np.int64)
        chars = classes.sum(axis=1)
        failed = np.array([b[0] < 50 or 100 * b[4] > 50 * b[0] for b in base], dtype=bool)
        by_char = by_word = np.full(len(texts), np.nan)
        if self.known:
            shares = classes / np.maximum(chars, 1)[:, None]
            by_char = np.min([js_distance(shares, r["classes"]) for r in self.known], axis=0)
            each = []
            for r, own in zip(self.known, self.own):
                got = words[:, own]
                full = np.concatenate([got, (n - got.sum(axis=1))[:, None]], axis=1) / np.maximum(n, 1)[:, None]
                each.append(js_distance(full, r["shares"]))
            by_word = np.min(each, axis=0)
            by_char = np.where(chars >= MIN_CHARS, by_char, np.nan)
            by_word = np.where(n >= MIN_WORDS, by_word, np.nan)
        # a comparison that was left out (nan) rejects nothing
        kept = ~failed & ~(by_char > MAX_CHAR_DISTANCE) & ~(by_word > MAX_WORD_DISTANCE)
        none = lambda v: [None if np.isnan(x) else float(x) for x in v]
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return {k: [b[i] for b in base] for i, k in enumerate(names)} | {
            "base_failed": failed.tolist(),
            "kept": kept.tolist(),
            "char_distance": none(by_char),
            "word_distance": none(by_word),
        }


SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "char_distance double, word_distance double"
)


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, base_failed, kept, and the distances where the text is long enough."""
    known = references(docs)

    def make():
        judged = Judge(known)
        return lambda ids, texts: {"doc_id": ids} | judged(texts)

    return map_slices(docs.select("doc_id", "text"), make, SCHEMA)


def keep_clean(docs: DataFrame) -> DataFrame:
    """The rows of docs that judge() keeps, all columns as they are."""
    known = references(docs)

    def make():
        judged = Judge(known)
        return lambda texts: judged(texts)["kept"]

    return filter_slices(docs, make, "text")
