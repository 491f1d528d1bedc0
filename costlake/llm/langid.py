"""Language identification by compression with per-language zstandard dictionaries.

A dictionary is raw text of one language; case and what stands between letters do not count. A text is compressed with each, in
blocks of BLOCK_BYTES that each start afresh from the dictionary, so that what a dictionary saves grows with the text; the
language whose dictionary makes it smallest is the prediction, and a narrow lead over the
second is a rejection (accepted is false). Training takes a bounded sample of labelled
texts, the SAMPLE_TEXTS distinct texts of each language that are first by a hash of the
text, however often a text is repeated; of these whole texts, cut into excerpts, a
dictionary holds those first by their hash. Prediction is a plain map over whole texts.

Defined cases: a null text or one without a letter is "und" with score 0; a very long text
is compressed whole, block by block; texts that all dictionaries compress alike go to the
language with more training texts, then the first by name; repeated rows are predicted
each for itself and train once; without training texts all are "und"; an empty table gives
an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import filter_slices, map_slices
from .scratch import materialize

#: Bounds of the training sample: distinct texts a language, characters of an excerpt, bytes of a dictionary.
SAMPLE_TEXTS, EXCERPT, DICTIONARY_BYTES = 256, 1024, 131_072
MIN_EVEN_BYTES = 16_384
LEVEL = 3
#: Bytes that are compressed at once.
BLOCK_BYTES = 4096
#: A prediction is accepted if the second smallest size is larger by this many bytes and this share.
MIN_LEAD_BYTES, MIN_LEAD_SHARE = 2, 0.01
UNKNOWN = "und"
BETWEEN = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return BETWEEN.sub(" ", text.lower())


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves remainder; false for a null key."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == remainder, F.lit(False))


def _first(rows: DataFrame, by: str, most: int) -> DataFrame:
    """The rows of each language whose number in by is among the most smallest; each task passes on so many only."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("_lang").orderBy(by))).where(F.col("_n") <= most).drop("_n")


def _first_hashes(hashes: DataFrame, most: int) -> DataFrame:
    """The most smallest hashes of each language, of distinct (_lang, _hash).

    Hashes of distinct texts lie evenly, so all but about twice as many are left out by a
    bound on the hash before they meet; fewer than most remain with a probability below 1e-30.
    """
    hashes = materialize(hashes, "langid-hashes")
    counts = hashes.groupBy("_lang").agg(F.count("*").alias("_of"))
    bound = F.lit(-(2.0**63)) + F.least(F.lit(1.0), 2.0 * most / F.col("_of")) * 2.0**64
    few = hashes.join(F.broadcast(counts), "_lang").where(F.col("_hash").cast("double") <= bound)
    return materialize(_first(few.drop("_of"), "_hash", most), "langid-sample")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> list[tuple[str, int, bytes]]:
    """(language, number of texts in the sample, dictionary), most texts first. Reads the texts with a language; no other column."""
    rows = labelled.select(F.col(text).alias("_text"), F.col(lang).alias("_lang")).where(F.col(lang).isNotNull() & (F.length(text) > 0))
    hashed = rows.withColumn("_hash", F.xxhash64("_text"))
    chosen = _first_hashes(hashed.select("_lang", "_hash").distinct(), SAMPLE_TEXTS)
    sample = hashed.join(F.broadcast(chosen), ["_lang", "_hash"], "left_semi").dropDuplicates(["_lang", "_hash", "_text"])
    cut = sample.select("_lang", "_hash", F.explode(F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{EXCERPT}}}+"), F.lit(0))).alias("_part"))
    cut = cut.withColumn("_place", F.struct(F.xxhash64("_part"), "_hash"))
    excerpts = _first(cut, "_place", DICTIONARY_BYTES // EXCERPT * 2).select("_lang", "_place", "_part").collect()
    sizes = {r["_lang"]: r["n"] for r in chosen.groupBy("_lang").agg(F.count("*").alias("n")).collect()}
    found = []
    for name, n in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        own = sorted((r for r in excerpts if r["_lang"] == name), key=lambda r: tuple(r["_place"]))
        content = b"\n".join(letters(r["_part"]).encode() for r in own)
        if content:
            found.append((name, n, content[:DICTIONARY_BYTES]))
    # a longer dictionary compresses any text better: all get the length of the shortest, down to a floor
    even = max(MIN_EVEN_BYTES, min((len(content) for _, _, content in found), default=0))
    return [(name, n, content[:even]) for name, n, content in found]


class Classifier:
    def __init__(self, trained: list[tuple[str, int, bytes]]):
        self.names = [name for name, _, _ in trained]
        self.compress = []
        for _, _, content in trained:
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.compress.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False).compress
            )

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, lead as a share of the second size, accepted)."""
        if not text or not self.names or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, 0.0, False
        raw = letters(text).encode()
        blocks = [raw[at : at + BLOCK_BYTES] for at in range(0, len(raw), BLOCK_BYTES)]
        sizes = [sum(len(c(b)) for b in blocks) for c in self.compress]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        others = sizes[:best] + sizes[best + 1 :]
        if not others:
            return self.names[best], 1.0, 1.0, True
        score = 1.0 / (1.0 + sum(2.0 ** -min(60, s - sizes[best]) for s in others))
        gap = min(others) - sizes[best]
        lead = gap / min(others)
        return self.names[best], score, lead, gap >= MIN_LEAD_BYTES and lead >= MIN_LEAD_SHARE


def classify(docs: DataFrame, trained: list[tuple[str, int, bytes]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, lead, accepted), one row per row of docs."""

    def make():
        predict = Classifier(trained).predict

        def work(ids, texts):
            found = [predict(t) for t in texts]
            return {key: ids} | {name: [f[i] for f in found] for i, name in enumerate(("lang_pred", "score", "lead", "accepted"))}

        return work

    return map_slices(docs.select(key, text), make, f"{key} long, lang_pred string, score double, lead double, accepted boolean")


def language_report(docs: DataFrame) -> DataFrame:
    """One row per document; learned from those whose crc32(doc_id as text) mod 3 is not 1."""
    apart = held_out(F.col("doc_id"), 3, 1)
    trained = train(docs.where(~apart & F.col("doc_id").isNotNull()))
    return classify(docs, trained).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score", "lead", "accepted")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is told with a sufficient lead; all rows if there is no language to learn."""
    trained = train(docs)
    if not trained:
        return docs

    def make():
        predict = Classifier(trained).predict
        return lambda texts: [predict(t)[3] for t in texts]

    return filter_slices(docs, make, "text")
