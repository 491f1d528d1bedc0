"""The conversations' prefix trie against a plain trie, for few and many shards and cut splitters."""

import hashlib
import random
import zlib

import pytest

from costlake.llm import prefixtrie

SF = "/root/testdata/sf0.01"
COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def brute(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    members, children = {}, {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        path = own.get(c - c % 5, [])[:h] + own[c][h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append((c, len(path)))
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved, out = {}, {}, []
    for p in sorted(members, key=len, reverse=True):
        own_children = children.get(p, [])
        leaves[p] = sum(leaves[x] for x in own_children) or 1
        saved[p] = sum(saved[x] for x in own_children) + (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c, n in m if n == len(p))))
        above = min(c for c, _ in members[p[:-1]]) if p else None
        out.append((min(c for c, _ in m), len(p), above, len(m), len(children.get(p, [])), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(seed=1):
    """Small alphabets, so that conversations share prefixes; a hot one; null keys, turns, roles and texts."""
    rng, rows = random.Random(seed), {}
    for c in range(300):
        for k in range(rng.randrange(0, 7)):
            rows[c * (1 if c % 7 else 5), rng.choice([k, k, None])] = (rng.choice(["a", "b", None]), rng.choice(["x", "é", None, ""]))
    for c in range(2000, 2600):
        for k in range(10):
            rows[c, k] = ("user", "hot")
    return [(c, t, *x) for (c, t), x in rows.items()] + [(None, 1, "a", "x")]


@pytest.fixture(scope="module")
def stored(spark):
    rows = made()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return rows, prefixtrie.materialize(prefixtrie.rebuild(prefixtrie.paths(df)), "rebuilt")


@pytest.mark.parametrize("cut", [{}, {"turns_a_shard": 300}, {"turns_a_shard": 500, "deepest": 2}, {"turns_a_shard": 500, "skeleton": 3}])
def test_against_a_plain_trie(spark, stored, cut):
    rows, paths = stored
    assert sorted(map(tuple, prefixtrie.trie(paths, **cut).select(*COLUMNS).collect()), key=str) == brute(rows)


def test_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(map(tuple, prefixtrie.conversation_trie(df).select(*COLUMNS).collect()), key=str) == want


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, path string, kind int, node string"
    assert prefixtrie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    only_null = spark.createDataFrame([(None, 1, "a", "b", "p", 1, "n")] * 2, schema)
    assert prefixtrie.conversation_trie(only_null).collect() == []
    # repeated rows are turns of their own; a very long text and a long conversation
    rows = [(10, 1, "a", "b")] * 3 + [(15, 1, None, "x" * 500_000)] + [(k, t, "u", "t") for k in (20, 25) for t in range(3000)]
    got = prefixtrie.conversation_trie(spark.createDataFrame([(*r, "p", 1, "n") for r in rows], schema))
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=str) == brute(rows)


def test_skeleton_nodes_are_few_and_shards_even(spark, stored):
    _, paths = stored
    points = prefixtrie.splitters(paths, 20)
    children, parent, depth = prefixtrie.skeleton_of(points)
    assert 15 <= len(points) <= 20 and len(children) <= 1 + sum(len(p) // 16 for p, _ in points)
    assert all(p < i for i, p in enumerate(parent)) and max(depth) >= 10
    hot = [c for p, c in points if 2000 <= c < 2600]
    assert len(hot) >= 5  # copies of one conversation are cut by their ids
