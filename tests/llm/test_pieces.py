"""Pieces, their places and decoding against the sentencepiece library, for several compiled maps."""

import hashlib
import random
import struct

import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import SentencePieceNormalizer

from costlake.llm import bpe, pieces

SF = "/root/testdata/sf0.001"
PATH = bpe.tokenizer_path(pieces.MODEL)
LETTERS = list("  ab the\n\t▁é漢😀\x00İﬁ<0x0A>　​0123Ⅷ½①ｶﾞ") + ["▁▁", "   ", "<s>", "</s>", "<unk>", "�", "the ", " of", "é", "ﷺ"]


def field(number, value):
    """A protocol-buffer field: whole numbers and strings of bytes."""

    def varint(n):
        out = bytearray()
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    return varint(number * 8) + varint(value) if isinstance(value, int) else varint(number * 8 + 2) + varint(len(value)) + value


def variant(folder, name, fallback=True, **norm):
    """The model file with the compiled map of a rule and other normaliser settings, without byte fallback if so told."""
    with open(PATH, "rb") as f:
        fields = list(pieces._fields(f.read()))
    spec = SentencePieceNormalizer(rule_name=name).serialized_model_proto()
    blob = next(dict(pieces._fields(v)).get(2, b"") for n, v in pieces._fields(spec) if n == 3)
    out = b""
    for n, v in fields:
        if n == 3:
            v = field(1, name.encode()) + field(2, blob) + field(3, norm.get("prefix", 1)) + field(4, norm.get("squeeze", 1)) + field(5, 1)
        if n == 2 and not fallback:
            v = v + field(35, 0)
        if n == 1 and not fallback and dict(pieces._fields(v)).get(3) == pieces.BYTE:
            v = field(1, b"~" + dict(pieces._fields(v))[1]) + b"\x15" + struct.pack("<f", -1e9) + field(3, pieces.NORMAL)
        out += field(n, v)
    path = f"{folder}/{name}-{fallback}-{'-'.join(map(str, norm.values()))}.model"
    with open(path, "wb") as f:
        f.write(out)
    return path


def agrees(own, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    raw, shown, _ = own.encode(text)
    assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == ids, text[:99]
    assert shown == library.decode(ids) == own.decode(ids), text[:99]
    found = library.encode(text, return_type="proto").pieces
    assert own.spans(text) == ([p.id for p in found], [p.begin for p in found], [p.end for p in found]), text[:99]


@pytest.mark.parametrize(
    "rule,norm",
    [("identity", {"squeeze": 0}), ("nmt_nfkc", {}), ("nmt_nfkc_cf", {"squeeze": 0}), ("nfkc", {"prefix": 0}), ("identity", {"prefix": 0, "squeeze": 1}), ("nmt_nfkc", {"squeeze": 0, "prefix": 0})],
)
def test_random_texts(tmp_path, rule, norm):
    path = variant(tmp_path, rule, **norm)
    own, library, rng = pieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(5)
    assert bool(own.map) == (rule != "identity")
    for _ in range(3000):
        agrees(own, library, "".join(rng.choice(LETTERS) for _ in range(rng.randrange(0, 30))))


def test_unknown_characters_without_bytes(tmp_path):
    path = variant(tmp_path, "identity", fallback=False, squeeze=0)
    own, library, rng = pieces.Model(path), sentencepiece.SentencePieceProcessor(model_file=path), random.Random(6)
    for _ in range(2000):
        agrees(own, library, "".join(rng.choice(LETTERS) for _ in range(rng.randrange(0, 30))))


def test_long_and_all_characters():
    own, library = pieces.model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("a" * 70_000, " " * 200_000, "x" + " " * 100_001 + "y", "ab" * 50_000, "漢" * 30_000):
        agrees(own, library, text)
    chars = ["a" + chr(c) + "b" + chr(c) * 3 + " " + chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for text, ids in zip(chars, library.encode(chars)):
        raw = own.encode(text)[0]
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw))[1:-1] == ids, text


def test_cuts_change_nothing(monkeypatch):
    own, library, rng = pieces.Model(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH), random.Random(7)
    words = [p for p in own.ids if len(p) < 5]
    monkeypatch.setattr(pieces, "KEPT_CUTS", 50)
    for _ in range(3000):
        text = "".join(rng.choice(words).replace("▁", " ") for _ in range(12))
        raw = own.encode(text)[0]
        assert list(struct.unpack(f"<{len(raw) // 4}I", raw)) == library.encode(text, add_bos=True, add_eos=True)
    assert len(own.known) <= 200


def test_tables(spark):
    made = spark.createDataFrame([(100_000 + i, t) for i, t in enumerate([None, "", " ", "a  b", "a  b", "é▁😀"])], "doc_id long, text string")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(made).withColumn("ids", F.lit("x")).withColumn("begins", F.lit(1))
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    encoded = pieces.encode(docs)
    spans = {r["doc_id"]: r for r in encoded.collect()}
    back = {r["doc_id"]: r["text"] for r in pieces.decode(encoded).collect()}
    report = {r["doc_id"]: r for r in pieces.piece_report(docs).collect()}
    assert spans.keys() == report.keys() == texts.keys()
    for k, text in texts.items():
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert spans[k]["ids"] == ids[1:-1] and back[k] == library.decode(ids)
        assert report[k]["n_tokens"] == len(ids) and report[k]["span_bytes"] == len(text.encode())
        assert report[k]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert report[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
        raw = text.encode()
        assert "".join(raw[a:b].decode() for a, b in zip(spans[k]["begins"], spans[k]["ends"])) == text


def test_report_takes_every_step(spark, tmp_path, monkeypatch):
    """The report's columns come from normalised texts, aligned spans and decoded ids, also for the query's own model, whose map is empty."""
    own, taken = pieces.Model(PATH), []
    for name in ("normalize", "decode"):
        monkeypatch.setattr(own, name, lambda x, name=name, step=getattr(own, name): taken.append(name) or step(x))
    raw, shown, held = own.encode("é 漢b ▁ \x00")
    assert taken == ["normalize", "decode"] and shown == "é 漢b   \x00" and held == len("é 漢b ▁ \x00".encode())
    # a map that shortens texts, squeezed spaces: spans hold what the library's spans hold
    path = variant(tmp_path, "nmt_nfkc")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["  ﬁne   ①  é ", "", "   ", "ｶﾞ  x ", None, "plain words"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pieces.piece_report(docs, path).collect():
        found = library.encode(texts[r["doc_id"]] or "", return_type="proto").pieces
        ids = library.encode(texts[r["doc_id"]] or "", add_bos=True, add_eos=True)
        assert r["span_bytes"] == sum(p.end - p.begin for p in found) and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
