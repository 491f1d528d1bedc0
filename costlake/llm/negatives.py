"""Hard negatives by blocked products of anchors and candidates, multiplied after Strassen.

Anchors are the stated query set; they are dealt into strips of bounded size, and every
strip meets all candidates where these are stored: the strip is broadcast, and each task
goes through its candidates tile by tile. A tile's scores are the product of two int64
matrices by Strassen's seven half-size products, recursively, with zeros to make the sides
even; sums wrap alike modulo 2**64, so what fits in 64 bits is exact. Each task keeps heaps
of KEEP rows: for every anchor its positives, and in a second pass, when these are
known, for every positive the negatives of its window. Heaps merge: the best of two are the
best of their union, so tasks pass on KEEP rows of a heap and one window function is left.

Defined cases: rows with a null key, a null label, a null vector or a component that is null
or not finite take no part; vectors of unequal length count as if zeros followed the shorter
one; repeated rows count each for itself, so that a repeated anchor has its copies among its
other rows and its results repeated; ties go to the smaller key; an anchor without positives
or windows without rows give no row; scores so large that 100 times one could leave 64 bits
are computed with whole numbers of any size, and the job fails if a result then does not
fit; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import arrow_schema, ship
from .scratch import materialize, shared_dir

#: Positives of an anchor, negatives of a positive; a negative has LOW to HIGH hundredths of the positive's score.
KEEP, LOW, HIGH = 5, 80, 100
#: Anchors of a strip and bytes of their vectors at most; anchors and candidates of a tile.
STRIP, STRIP_BYTES, TILE = 4096, 32 << 20, (256, 2048)
#: Sides up to which matrices are multiplied directly.
LEAF = 32
FOUND = "place long, anchor_id long, positive_place long, positive_id long, positive_score long, other_id long, score long"


def _even(a: np.ndarray) -> np.ndarray:
    """a with a row and a column of zeros where it has an odd number of them."""
    out = np.zeros((a.shape[0] + a.shape[0] % 2, a.shape[1] + a.shape[1] % 2), dtype=a.dtype)
    out[: a.shape[0], : a.shape[1]] = a
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b of whole numbers. Halves each side that is still longer than LEAF, seven products a level."""
    (n, m), k = a.shape, b.shape[1]
    if min(n, m, k) <= LEAF:
        return a @ b
    if n % 2 or m % 2 or k % 2:
        return strassen(_even(a), _even(b))[:n, :k]
    n, m, k = n // 2, m // 2, k // 2
    a11, a12, a21, a22 = a[:n, :m], a[:n, m:], a[n:, :m], a[n:, m:]
    b11, b12, b21, b22 = b[:m, :k], b[:m, k:], b[m:, :k], b[m:, k:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    p6 = strassen(a21 - a11, b11 + b12)
    p7 = strassen(a12 - a22, b21 + b22)
    out = np.empty((2 * n, 2 * k), dtype=a.dtype)
    out[:n, :k] = p1 + p4 - p5 + p7
    out[:n, k:] = p3 + p5
    out[n:, :k] = p2 + p4
    out[n:, k:] = p1 - p2 + p3 + p6
    return out


class Heaps:
    """For each of n owners the keep best (score, id) pairs seen, higher scores first, then smaller ids."""

    def __init__(self, n: int, keep: int, dtype):
        self.keep = keep
        self.owner, self.score, self.id = np.empty(0, dtype=np.int64), np.empty(0, dtype=dtype), np.empty(0, dtype=np.int64)
        self.least = [None] * n  # the last kept score of a full heap

    def merge(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        owner, score, ids = np.concatenate([self.owner, owner]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.empty(0, dtype=np.int64)
        place = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
        kept = place < self.keep
        self.owner, self.score, self.id = owner[kept], score[kept], ids[kept]
        for o, s in zip(self.owner[place[kept] == self.keep - 1].tolist(), self.score[place[kept] == self.keep - 1].tolist()):
            self.least[o] = s

    def offer(self, owners: range, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Scores (owners x ids) where allowed; ids ascend. Of a row only what can be among its keep best goes on."""
        rows, columns = [], []
        for r, o in enumerate(owners):
            cut = np.flatnonzero(allowed[r])
            values = scores[r, cut]
            if self.least[o] is not None:
                better = values >= self.least[o]
                cut, values = cut[better], values[better]
            if len(cut) > self.keep:
                least = np.partition(values, len(values) - self.keep)[len(values) - self.keep]
                above = np.flatnonzero(values > least)
                even = np.flatnonzero(values == least)[: self.keep - len(above)]
                cut = cut[np.concatenate([above, even])]
            if len(cut):
                rows.append(np.full(len(cut), r))
                columns.append(cut)
        if rows:
            rows, columns = np.concatenate(rows), np.concatenate(columns)
            self.merge(rows + owners.start, scores[rows, columns], ids[columns])


def _stacked(column: pa.ListArray, width: int, dtype) -> np.ndarray:
    """Vectors as rows of a matrix, with zeros behind the shorter ones."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out.astype(dtype)


def _best(spark, candidates: DataFrame, strip: list, windows: list | None, width: int, dtype, tile: tuple[int, int]) -> DataFrame:
    """FOUND rows of each task's heaps: positives of the strip's anchors, or with windows the negatives of these."""
    place, ids = np.array([r["_row"] for r in strip]), np.array([r["vec_id"] for r in strip])
    labels = np.array([r["label"] for r in strip])
    vectors = np.zeros((len(strip), width), dtype=dtype)
    for i, r in enumerate(strip):
        vectors[i, : len(r["vec"])] = r["vec"]
    row_of = {p: i for i, p in enumerate(place.tolist())}
    # (anchor's row, its positive's place, id, score), by anchor
    wanted = sorted((row_of[w["place"]], w["positive_place"], w["positive_id"], w["positive_score"]) for w in windows or [])
    held = spark.sparkContext.broadcast((place, ids, labels, vectors, wanted))
    names = arrow_schema(FOUND)

    def run(batches):
        place, ids, labels, vectors, wanted = held.value
        heaps = Heaps(len(wanted) if windows is not None else len(ids), KEEP, dtype)
        of_anchor: dict[int, list[int]] = {}
        for k, w in enumerate(wanted):
            of_anchor.setdefault(w[0], []).append(k)
        for batch in batches:
            for start in range(0, batch.num_rows, tile[1]):
                part = batch.slice(start, tile[1])
                own = part.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(own, kind="stable")
                own, label = own[order], part.column(1).to_numpy(zero_copy_only=False)[order]
                right = np.ascontiguousarray(_stacked(part.column(2), width, dtype)[order].T)
                number = part.column(3).to_numpy(zero_copy_only=False)[order]
                for at in range(0, len(ids), tile[0]):
                    to = min(at + tile[0], len(ids))
                    scores = strassen(vectors[at:to], right)
                    same = labels[at:to, None] == label[None, :]
                    if windows is None:
                        heaps.offer(range(at, to), scores, same & (place[at:to, None] != number[None, :]), own)
                        continue
                    owners = [k for i in range(at, to) for k in of_anchor.get(i, ())]
                    if owners:
                        rows = np.array([wanted[k][0] - at for k in owners])
                        top = np.array([wanted[k][3] for k in owners], dtype=dtype)[:, None]
                        mine = scores[rows]
                        allowed = ~same[rows] & (LOW * top <= 100 * mine) & (100 * mine <= HIGH * top)
                        heaps.offer(range(owners[0], owners[-1] + 1), mine, allowed.astype(bool), own)
        if windows is None:
            rows = [(int(place[o]), int(ids[o]), None, None, None, int(i), int(s)) for o, i, s in zip(heaps.owner, heaps.id, heaps.score)]
        else:
            rows = []
            for o, i, s in zip(heaps.owner, heaps.id, heaps.score):
                a, p, positive, top = wanted[o]
                rows.append((int(place[a]), int(ids[a]), p, positive, top, int(i), int(s)))
        for at in range(0, len(rows), 65_536):
            yield pa.RecordBatch.from_pylist([dict(zip(names.names, r)) for r in rows[at : at + 65_536]], schema=names)

    return candidates.mapInArrow(run, FOUND)


def _ranked(found: DataFrame, owner: list[str]) -> DataFrame:
    """The KEEP best of each owner over all tasks, numbered from 1."""
    order = W.partitionBy(*owner).orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= KEEP)


def vectors(table: DataFrame, label: Column | None = None) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part: components as floor(256 * x)."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine)
    vec = F.transform("embedding", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return rows.select("vec_id", (F.col("label") if label is None else label).cast("long").alias("label"), vec.alias("vec"))


def mine(rows: DataFrame, is_anchor: Column, strip: int = STRIP, tile: tuple[int, int] = TILE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over rows (vec_id, label, vec)."""
    spark = rows.sparkSession
    ship(spark)
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    size = lambda x: F.when(x < 0, -x.cast("decimal(20,0)")).otherwise(x.cast("decimal(20,0)"))
    width, largest, anchors = rows.agg(
        F.max(F.size("vec")), F.max(size(F.array_max("vec"))), F.count_if(is_anchor)
    ).first()
    lowest = rows.agg(F.max(size(F.array_min("vec")))).first()[0]
    most = int(max(largest or 0, lowest or 0))
    width = max(1, width or 0)
    dtype = np.int64 if 100 * most * most * width < 2**63 else object
    own = materialize(rows.where(is_anchor).withColumn("_place", F.monotonically_increasing_id()), "anchors")
    task, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    before = own.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    before = before.select("_task", (F.sum("_n").over(W.orderBy("_task")) - F.col("_n")).alias("_before"))  # a row a task
    own = materialize(own.join(F.broadcast(before), task == F.col("_task")).withColumn("_number", F.col("_before") + place).drop("_task", "_before", "_place"), "anchors")
    strip = max(1, min(strip, STRIP_BYTES // (8 * width)))
    path = f"{shared_dir(spark)}/costlake/negatives-{uuid.uuid4().hex}"
    for at in range(0, anchors, strip):
        chosen = own.where(F.col("_number").between(at, at + strip - 1)).collect()
        positives = _ranked(_best(spark, rows, chosen, None, width, dtype, tile), ["place"]).select(
            "place", F.col("rank").cast("long").alias("positive_place"), F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score")
        ).collect()
        _ranked(_best(spark, rows, chosen, positives, width, dtype, tile), ["place", "positive_place"]).write.mode("append").parquet(path)
    found = spark.read.schema(f"{FOUND}, rank int").parquet(path) if anchors else spark.createDataFrame([], f"{FOUND}, rank int")
    return found.select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Rows whose key is divisible by 100 are anchors; labels of keys divisible by 7 are moved on by one of ten first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors(embeddings, moved), F.col("vec_id") % 100 == 0)
