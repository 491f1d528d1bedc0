"""Connected components of a link table as alternating joins, with the lineage cut each round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import ship
from .scratch import contained, materialize

#: A key with more than one in MOST_HOT of all rows, and LEAST_HOT at least, is hot; there are MOST_HOT of them at most.
MOST_HOT, LEAST_HOT = 2000, 200
#: Nodes that a task holds at once while it makes links to stars.
HELD = 262_144


def attach(rows: DataFrame, table: DataFrame, key: str, counted: str | None = None, most_hot: int = MOST_HOT) -> DataFrame:
    """Inner join of rows with table, which has one row a key; both should be stored.

    Rows of hot keys meet their table rows by a broadcast of at most most_hot rows, and the
    other keys have few rows each, so that no task gets a hot key's rows. The column of
    table that holds each key's number of rows is named by counted, if there is one.
    """
    counts = table.select(key, F.col(counted).alias("_n")) if counted else rows.groupBy(key).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(LEAST_HOT, (total or 0) // most_hot)
    if (most or 0) <= limit:
        return rows.join(table, key)
    hot = materialize(table.join(counts.where(F.col("_n") > limit).select(key), key), "hot")
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(table, key))


def forest(links: DataFrame) -> DataFrame:
    """(a, b): stars that connect what the links (a, b) of each task connect, HELD nodes at a time; b is the smallest node of its star."""
    names, held = ["a", "b"], HELD
    ship(links.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        above: dict[int, int] = {}

        def root(node: int) -> int:
            top = node
            while (up := above.get(top)) is not None:
                top = up
            while node != top:
                above[node], node = top, above[node]
            return top

        def stars() -> pa.RecordBatch:
            nodes = list(above)
            return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())], names)

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    above[max(a, b)] = min(a, b)
            if len(above) >= held:
                yield stars()
                above.clear()
        if above:
            yield stars()

    return links.select("a", "b").mapInArrow(run, "a long, b long")


@contained("components")
def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every end of links (a, b), long numbers: label is the smallest node reachable.

    Links become stars task by task, once where they arise and once where they are read.
    Each round then hangs every node's larger neighbours under the node's smallest neighbour
    (large star), then its smaller neighbours (small star), until all links are stars that
    do not touch; the number of rounds grows with the logarithm of the longest path. Minima
    are aggregated before any shuffle and hot centres are joined by broadcast, never gathered.
    """
    links = materialize(forest(links), "links")
    for _ in range(most_rounds):
        links = materialize(forest(links), "links")
        none = F.lit(None).cast("long")
        both = links.select(F.col("a").alias("node"), "b", F.lit(0).alias("n")).union(links.select(F.col("b").alias("node"), none.alias("b"), F.lit(1).alias("n")))
        # all neighbours b are smaller than a, so that a node's least neighbour is its least b or else itself
        ends = both.groupBy("node").agg(F.min("b").alias("lo"), F.max("b").alias("hi"), F.sum("n").alias("n"))
        ends = materialize(ends.select("node", F.coalesce("lo", "node").alias("m"), F.expr("lo <> hi or n > 0 and lo is not null").alias("loose"), "n"), "least")
        if ends.where("loose").isEmpty():
            return ends.select("node", F.col("m").alias("label"))
        least = ends.where("n > 0").select(F.col("node").alias("b"), "m", "n")
        large = materialize(attach(links, least, "b", "n").select("a", F.col("m").alias("b")), "large")
        # small star: a's neighbours are all smaller
        root = materialize(large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "root")
        joined = attach(large, root, "a", "n")
        small = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(root.select("a", F.col("m").alias("b")))
        links = materialize(forest(small), "links")
    raise RuntimeError(f"links did not settle in {most_rounds} rounds")
