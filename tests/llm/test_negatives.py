"""Hard negatives against a full sort in plain Python; Strassen products against plain ones."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from costlake.llm import negatives

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    fine = []
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        fine.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for a in fine:
        if a[0] % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in fine if b is not a)
        for s, p, _ in [x for x in scored if x[2] == a[1]][: negatives.KEEP]:
            window = [x for x in scored if x[2] != a[1] and -80 * s <= -100 * x[0] <= -100 * s][: negatives.KEEP]
            out += [(a[0], p, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(window)]
    return sorted(out)


def mined(df, **cut):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(negatives.vectors(df, moved), F.col("vec_id") % 100 == 0, **cut) if cut else negatives.hard_negatives(df)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 40, 35), (64, 96, 200), (70, 33, 129), (5, 300, 7)])
def test_strassen(shape):
    rng = np.random.default_rng(1)
    n, m, k = shape
    a, b = (rng.integers(-(2**28), 2**28, s) for s in ((n, m), (m, k)))
    assert (negatives.strassen(a, b) == a @ b).all()
    exact = negatives.strassen(a.astype(object) * 2**40, b.astype(object))
    assert (exact == (a.astype(object) * 2**40) @ b.astype(object)).all()


@pytest.mark.parametrize("cut", [{}, {"strip": 2, "tile": (2, 37)}, {"strip": 3, "tile": (1, 500)}])
def test_table(spark, cut):
    df = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label")
    assert mined(df, **cut) == brute([tuple(r) for r in df.collect()])


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(400) * (100 if k % 20 == 0 else 1), [float(rng.randrange(3)), 0.5], rng.randrange(3)) for k in range(300)]
    rows += rows[:40] + [(700, [1.0, 1.0], 1)] * 9
    odd = [(None, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (5, [1.0, 1.0], None), (6, [-1.0, -2.0], 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA).withColumn("place", F.lit("x")).withColumn("_row", F.lit(1)).repartition(3)
    want = brute(rows + odd)
    assert mined(df) == want and mined(df, strip=4, tile=(3, 16)) == want


def test_short_vectors_and_large_numbers(spark):
    rows = [(0, [1e6, 2.0], 1), (1, [1e6, 1.0], 1), (2, [9e5, 1.0], 2), (3, [9e5], 2), (100, [], 1), (7, [9e5, 1.0], 0), (9, [9e5, 1.0], 2), (200, [-1.0], 1)]
    padded = [(i, e + [0.0] * (2 - len(e)), label) for i, e, label in rows]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(padded)


def test_empty(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(100, [1.0], 1)], SCHEMA)) == []
