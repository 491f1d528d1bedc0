"""Connected components against a search, and what they and the near-duplicate stage leave in the shared folder."""

import os
import random

import pytest
from pyspark.sql import functions as F

from costlake.llm import components as parts
from costlake.llm import minhash, scratch


def expected(links):
    root = {}

    def find(k):
        while root.setdefault(k, k) != k:
            k = root[k]
        return k

    for a, b in links:
        x, y = find(a), find(b)
        if a != b:
            root[max(x, y)] = min(x, y)
    ends = {k for a, b in links if a != b for k in (a, b)}
    return {k: find(k) for k in ends}


def found(spark, links, tasks=7):
    rows = spark.createDataFrame(links, "a long, b long").repartition(tasks)
    out = parts.components(rows).collect()
    assert len(out) == len({r["node"] for r in out})
    return {r["node"]: r["label"] for r in out}


def stored(spark):
    folder = f"{scratch.shared_dir(spark)}/costlake"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


@pytest.mark.parametrize("held", [2, 262_144])
def test_components(spark, monkeypatch, held):
    """Chains, hubs and random links, with repeated, reversed and own links; tasks that hold few nodes at once change nothing."""
    monkeypatch.setattr(parts, "HELD", held)
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(300)]
    rng.shuffle(chain)
    hub = [(5000 - i, 9000 + i) for i in range(40)] + [(9000 + i, 4000) for i in range(40)]
    loose = [(rng.randrange(10_000, 10_400), rng.randrange(10_000, 10_400)) for _ in range(300)]
    links = chain + hub + loose + chain[:9] + [(b, a) for a, b in hub] + [(7, 7), (99_999, 99_999), (-5, 3)]
    assert found(spark, links) == expected(links)
    assert found(spark, []) == {} == found(spark, [(1, 1)])


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    names, store = [], parts.materialize
    monkeypatch.setattr(parts, "materialize", lambda df, name: names.append(name) or store(df, name))
    links = [(i, i % 5) for i in range(5, 400)]
    assert found(spark, links) == expected(links)
    assert names == ["links", "links", "least"]


def test_what_is_stored_on_the_way_goes(spark):
    before = stored(spark)
    assert parts.components(spark.createDataFrame([(2, 1), (3, 2)], "a long, b long")).count() == 3
    (left,) = stored(spark) - before
    assert left.startswith("components-")
    docs = spark.createDataFrame([(i, f"a b c d e f g h {i % 3}") for i in range(9)], "doc_id long, text string")
    kept = minhash.keep_one_of_each(docs)
    assert [n.rpartition("-")[0] for n in stored(spark) - before - {left}] == ["minhash-kept"]
    assert kept.count() == 3

    @scratch.contained("outer")
    def fails(df):
        scratch.materialize(df, "inner")
        raise ValueError("no")

    before = stored(spark)
    with pytest.raises(ValueError, match="no"):
        fails(docs.where(F.col("doc_id") > 2))
    assert stored(spark) == before
