"""The near-duplicate stage against exact Jaccard similarity of all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from costlake.llm import minhash

SF = "/root/testdata/sf0.001"


def grams(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def expected(rows):
    """Smallest id of each component of pairs that share 4/5 of their shingles."""
    root = {k: k for k in rows}
    sets = {k: grams(t) for k, t in rows.items()}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = sorted(rows)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k for k in keys if find(k) == k}


def edited(rng, text, changes):
    words = text.split()
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"x{rng.random()}"
    return " ".join(words)


def test_near_copies_by_jaccard(spark):
    rng = random.Random(4)
    rows = {}
    for base in range(30):
        text = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(60, 400)))
        rows[10 * base] = text
        for i, share in enumerate((0.002, 0.01, 0.018, 0.025, 0.04), 1):
            rows[10 * base + i] = edited(rng, text, max(1, round(share * len(text.split()))))
    rows |= {900: "", 901: None, 902: " A  b", 903: "a B", 904: "a c"}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows)


def test_table_by_jaccard(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows)
    assert minhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_chain_of_near_copies(spark):
    """Each text links with the one before it only: the whole chain is one component."""
    words = [f"w{i}" for i in range(400)]
    rows = {i: " ".join(words[5 * i : 5 * i + 200]) for i in range(30)}
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows) == {0}


def test_shared_passages_make_no_pairs(spark):
    """Texts that have half their words from one passage are left out before any comparison; near copies among them are found."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    passage = " ".join(word() for _ in range(120))
    rows = {i: f"{' '.join(word() for _ in range(60))} {passage} {' '.join(word() for _ in range(60))}" for i in range(80)}
    sets = minhash.shingle_sets(spark.createDataFrame([(t,) for t in rows.values()], "_text string"), 5)
    assert minhash.viable(sets).isEmpty()
    assert minhash.across(sets.withColumn("label", F.col("node"))).isEmpty()
    for i in range(0, 80, 4):
        rows[100 + i] = edited(rng, rows[i], 3)
        rows[200 + i] = edited(rng, rows[i], 9)  # about 0.7: no near copy
    copies = [t for k, t in rows.items() if k < 200]
    sets = minhash.shingle_sets(spark.createDataFrame([(t,) for t in copies], "_text string"), 5)
    assert minhash.viable(sets).count() == 40 and minhash.across(sets.withColumn("label", F.col("node"))).count() == 20
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows)


def test_variants_just_below_the_bound_make_few_pairs(spark):
    """Variants of one text, most pairs of which are too far apart: pairs are proposed for those that shared shingles leave possible."""
    rng = random.Random(2)
    base = " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(150))
    rows = {i: edited(rng, base, rng.choice((4, 5, 6))) for i in range(150)}
    sets = minhash.shingle_sets(spark.createDataFrame([(t,) for t in rows.values()], "_text string"), 5)
    pairs = minhash.across(sets.withColumn("label", F.col("node"))).collect()
    near = [(a, b) for a in rows for b in rows if a < b and 9 * len(grams(rows[a]) & grams(rows[b])) >= 4 * (len(grams(rows[a])) + len(grams(rows[b])))]
    found = {(r["a"], r["b"]) for r in pairs}
    node = {k: minhash.node_of(t) for k, t in rows.items()}
    assert {tuple(sorted((node[a], node[b]))) for a, b in near} <= found and len(found) < 150 * 149 // 8
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows)


def test_crowded_ends_are_dealt(spark, monkeypatch):
    """Pairs of one text in very many pairs meet copies of its set, and each pair is judged once."""
    monkeypatch.setattr(minhash, "LEAST_HOT", 4)
    monkeypatch.setattr(minhash, "MOST_HOT", 10)
    sets = {0: list(range(20)), **{i: list(range(i % 4, 20)) for i in range(1, 60)}, 60: [99]}
    rows = spark.createDataFrame(list(sets.items()), "node long, grams array<long>")
    pairs = spark.createDataFrame([(0, i) for i in range(1, 61)], "a long, b long")
    assert sorted(tuple(r) for r in minhash.similar(pairs, rows).collect()) == [(0, i) for i in range(1, 60)]
    crowd = minhash.crowded(pairs, "a").collect()
    assert [tuple(r) for r in crowd] == [(0, 10)] and minhash.crowded(pairs, "b").isEmpty()


def test_near_copies_without_a_bucket_in_common(spark, monkeypatch):
    """Buckets only propose: near copies none of whose buckets are equal are found all the same."""
    monkeypatch.setattr(minhash, "buckets", lambda grams, factors, summands: [int(grams.sum(dtype="uint64").view("int64"))])
    rng = random.Random(11)
    rows = {}
    for base in range(0, 200, 10):
        text = " ".join(f"w{rng.randint(0, 9999)}" for _ in range(rng.randint(80, 300)))
        rows[base] = text
        for i, share in enumerate((0.01, 0.018, 0.022), 1):
            rows[base + i] = edited(rng, text, max(1, round(share * len(text.split()))))
    docs = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in minhash.keep_one_of_each(docs).collect()} == expected(rows)


def test_smallest_hashes_of_near_copies_meet():
    """Each of two sets at the bound shares the hashes that are asked of it, whatever their sizes."""
    np = minhash.np
    rng = np.random.default_rng(5)
    for union in [*range(1, 130), 400, 1000]:
        for _ in range(20):
            both = rng.integers(0, 2**64, union, dtype=np.uint64)
            left = rng.integers(0, union // 5 + 1)  # of the fifth that need not be shared, how much the first set lacks
            one, other = np.unique(both[left:]), np.unique(np.concatenate([both[:left], both[union // 5 :]]))
            shared = len(np.intersect1d(minhash.smallest(one), minhash.smallest(other)))
            assert all(shared >= max(1, len(s) // minhash.EXTRA) for s in (one, other)), (union, left)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_exploded_rows_are_not_broadcast(spark):
    """Spark takes them to be as few as the rows they come from."""
    sets = minhash.shingle_sets(spark.createDataFrame([("a b c d e f g",), ("a b c d e f h",)], "_text string"), 5)
    sets = minhash.materialize(sets.withColumn("label", F.col("node")), "sets")
    for frame in (minhash.viable(sets), minhash.to_hubs(sets), minhash.across(sets)):
        assert "BroadcastHashJoin" not in plan(frame) and "SortMergeJoin [gram" in plan(frame)
