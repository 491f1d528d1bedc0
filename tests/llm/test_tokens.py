"""Packing and encoding against the tokenizers library, near-duplicates against all pairs."""

import hashlib
import random
import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from costlake.llm import bpe, packing, simhash

SF = "/root/testdata/sf0.001"
TEXTS = [
    None,
    "",
    " \n\t\x1c\x85　",
    "<|endoftext|> a<|startoftext|>B <|endoftext|>",
    "ΣΑΣ ΌΔΟΣ İstanbul ﬁ Ⅷ ½ é é ǅ",
    "It's we'll I'M 12345 ... !!!??? 漢字かな 😀😀 ​",
    "\x00\x01 nul",
    "a" * 70000,
    "ab " * 40000,
    "one two three four five",
    "one two three four five",
    "ONE two\tthree\nfour five",
    "one two three",
]


@pytest.fixture(scope="module")
def docs(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    made = spark.createDataFrame([(100000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    return real.select("doc_id", "text").unionByName(made).withColumn("fp", F.lit(1)).withColumn("label", F.lit("x")).cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def test_packing(docs, texts):
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {k: [*t.encode(v or "", add_special_tokens=False).ids, 1] for k, v in texts.items()}
    rows = packing.pack(docs).collect()
    assert len({(r["doc_id"], r["start"]) for r in rows}) == len(rows)
    of_doc, of_sequence = defaultdict(int), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
        of_doc[r["doc_id"]] += r["length"]
        of_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert of_doc == {k: len(v) for k, v in ids.items()}
    assert sorted(of_sequence) == list(range(len(of_sequence)))
    for parts in of_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(of_sequence) <= 1.03 * sum(of_doc.values()) / 2048 + 1


ODD = ["x" + " " * 1_000_000 + "y", "\n" * 1_200_000, "a" + " " * 4000 + "<|endoftext|>" + " " * 4000 + "b  c" + "\n" * 2500, "x" + " \t" * 3000 + "\u3000y", "a" + "\x1c" * 3000]


def test_long_runs_of_white_space():
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing._encoder(public_tokenizers.path(packing.RANKS))
    for text in ODD + [" " * n + end for n in (1999, 2000, 2001) for end in ("", "x", "\tx", "<|endoftext|>")]:
        assert encode(text).tolist() == t.encode(text, add_special_tokens=False).ids


def test_ids_of_pieces(spark):
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {1: "some words " * 3000, 2: None, 3: "é😀" * 50}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = packing.pack(docs, with_ids=True).collect()
    for k, text in texts.items():
        own = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["start"])
        assert sum((r["ids"] for r in own), []) == [*t.encode(text or "", add_special_tokens=False).ids, 1]


def characters():
    """Strings that hold each character beside letters, repeated, and alone."""
    chars = (chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    return ["a" + c + "b" + c * 3 + " " + c for c in chars]


def test_all_characters_pack_like_the_library():
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode, texts = packing._encoder(public_tokenizers.path(packing.RANKS)), characters()
    assert [s for s, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)) if encode(s).tolist() != e.ids] == []


def test_all_characters_encode_like_the_library():
    path = bpe.tokenizer_path(bpe.TOKENIZER)
    t, encoder, texts = Tokenizer.from_file(path), bpe.TrieEncoder(path), characters()
    for at in range(0, len(texts), 8192):
        part = texts[at : at + 8192]
        for s, (ids, _), e in zip(part, encoder.encode(part), t.encode_batch(part, add_special_tokens=False)):
            assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == e.ids, s


def test_plan_holds_the_demand_in_few_sequences():
    rng = np.random.default_rng(3)
    for units in (16, 64):
        demand = rng.integers(0, 400, units)
        demand[3] = 100_000
        plan = packing.plan_sequences(demand, units)
        held = np.zeros(units, dtype=int)
        for times, pattern in plan:
            assert sum(s * n for s, n in pattern) <= units
            for s, n in pattern:
                held[s - 1] += times * n
        assert (held == demand).all()
        bound = -(-int((demand * np.arange(1, units + 1)).sum()) // units)
        assert sum(t for t, _ in plan) <= 1.005 * bound + units


def test_bpe(docs, texts):
    t = Tokenizer.from_file(bpe.tokenizer_path(bpe.TOKENIZER))
    rows = {r["doc_id"]: r for r in bpe.bpe_report(docs).collect()}
    assert rows.keys() == texts.keys()
    for k, v in texts.items():
        ids = t.encode(v or "", add_special_tokens=False).ids
        assert rows[k]["n_tokens"] == len(ids), repr(v)[:99]
        assert rows[k]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        decoded = t.decode(ids, skip_special_tokens=False)
        assert rows[k]["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_trie_encoder_on_random_words():
    rng = random.Random(5)
    path = bpe.tokenizer_path(bpe.TOKENIZER)
    encoder, t = bpe.TrieEncoder(path), Tokenizer.from_file(path)
    tokens = [x.replace("</w>", "") for x in t.get_vocab() if x.replace("</w>", "").isascii() and x.replace("</w>", "").isalpha()]
    tokens.sort()
    words = ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 4))) for _ in range(8000)]
    words += ["".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    words += [c * n for c in "a!.-é" for n in range(1, 120)]
    for w, (ids, decoded), e in zip(words, encoder.encode(words), t.encode_batch(words, add_special_tokens=False)):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == e.ids, w
        assert decoded == t.decode(e.ids, skip_special_tokens=False)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_simhash(docs, texts):
    prints = {k: brute_fingerprint(v) for k, v in texts.items()}
    rows = simhash.near_duplicate_report(docs).collect()
    assert {r["doc_id"]: int(r["fingerprint"], 16) for r in rows} == prints
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints)


def test_links_of_crafted_fingerprints(spark):
    rng = random.Random(11)
    prints = []
    for _ in range(40):
        at = rng.getrandbits(64)
        for _ in range(12):  # a chain whose ends are far apart
            prints.append(at)
            for bit in rng.sample(range(64), rng.choice([1, 2, 3, 4, 4, 4, 5, 6])):
                at ^= 1 << bit
    centre = rng.getrandbits(64)
    prints += [centre ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)][:300]
    prints = list(dict.fromkeys(prints))
    points = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp long")
    got = {r["fp"] & (2**64 - 1): r["label"] for r in simhash.link_components(points).collect()}
    want = brute_components({i: p for i, p in enumerate(prints)})
    groups = lambda m: sorted(sorted(k for k in m if m[k] == v) for v in set(m.values()))
    assert groups(got) == groups({prints[i]: c for i, c in want.items()})


def test_empty(docs):
    none = docs.limit(0)
    assert packing.pack(none).count() == bpe.bpe_report(none).count() == simhash.near_duplicate_report(none).count() == 0
