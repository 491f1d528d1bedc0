"""SimHash near-duplicates by segment popcounts.

A fingerprint of 64 bits becomes a point of 32 coordinates, the number of ones in each
segment of two bits. Two fingerprints that differ in d bits lie at a Manhattan distance
of at most d, so the distance of the points is a lower bound. The coordinates are dealt
into BANDS bands; if the distance is at most MAX_BITS, at most so many bands differ, and
the points share the grid cell of BANDS - MAX_BITS bands at least. A point has a cell for
each choice of so many bands (70 for 8 and 4), each of them 16 coordinates wide, so that
two random points meet in one of 100,000 pairs. Points that share a cell are compared by
the distance of the points first, then bit by bit. No pair is missed.

Equal fingerprints are one point from the start. Points within reach of their cell's
smallest fingerprint are joined to it first, and pairs already in one component are left
out of the join's result, so that a large group of near copies gives about as many links
as it has members.

Defined cases: a null text counts as empty; texts without words have fingerprint zero,
which links like any other; a very long text is hashed whole; ties between components do
not arise, the smallest key names each; a bit set in exactly half of the hashes is 0;
repeated rows keep their row and share a component; rows without a key come last and name
a component only if it has no key; an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import map_slices
from .components import attach, components
from .scratch import contained, materialize

#: Bands hold 64 / BANDS bits, in whole segments of two.
SHINGLE, MAX_BITS, BANDS = 4, 4, 8


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """XXH64 of each run of shingle words, or of all words if they are fewer: bytes.lower() and bytes.split() touch ASCII letters and white space only."""
    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(joined, 42)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-shingle]))
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist())]


def fingerprint_of(text: str | None, shingle: int = SHINGLE, hashes: list[int] | None = None) -> int:
    """Unsigned fingerprint of one text, whose shingle_hashes may be given; of a text without words zero."""
    if not (text or "").strip(" \t\n\x0b\x0c\r"):
        return 0
    hashes = hashes or shingle_hashes(text, shingle)
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int.from_bytes(np.packbits(over).tobytes(), "big")


def signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp): fp is the fingerprint as a signed long."""

    def make():
        return lambda ids, texts: {key: ids, "fp": [signed(fingerprint_of(t, shingle)) for t in texts]}

    return map_slices(docs.select(key, text), make, f"{key} long, fp long")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _popcounts(fp: Column) -> Column:
    """The 32 counts, two bits each: of the two bits of a segment, "and" is the count's upper bit and "xor" its lower."""
    every_other = F.lit(0x5555555555555555).cast("long")
    a, b = fp.bitwiseAND(every_other), F.shiftrightunsigned(fp, 1).bitwiseAND(every_other)
    return F.shiftleft(a.bitwiseAND(b), 1).bitwiseOR(a.bitwiseXOR(b))


def _cells(points: DataFrame, max_bits: int, bands: int) -> DataFrame:
    """points, with one row for each choice of bands - max_bits bands, whose cell is a hash of the choice and its counts."""
    width = 64 // bands
    counts = _popcounts(F.col("fp"))
    cells = []
    for i, chosen in enumerate(combinations(range(bands), bands - max_bits)):
        mask = sum(((1 << width) - 1) << (width * band) for band in chosen)
        cells.append(F.xxhash64(F.lit(i), counts.bitwiseAND(F.lit(signed(mask)).cast("long"))))
    # few bytes become many rows: they are dealt anew, to as many tasks as the session shuffles to
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return points.repartition(parts, F.xxhash64("fp")).select("*", F.explode(F.array(*cells)).alias("cell"))


def _manhattan(a: Column, b: Column) -> Column:
    """Distance of two points: the differing bits less those that cancel out within a segment."""
    every_other = F.lit(0x5555555555555555).cast("long")
    both = a.bitwiseXOR(b)
    flipped = both.bitwiseAND(F.shiftrightunsigned(both, 1)).bitwiseAND(every_other)
    mixed = a.bitwiseXOR(F.shiftrightunsigned(a, 1)).bitwiseAND(every_other)
    return F.bit_count(both) - 2 * F.bit_count(flipped.bitwiseAND(mixed))


def _within(a: Column, b: Column, max_bits: int) -> Column:
    return (_manhattan(a, b) <= max_bits) & (hamming(a, b) <= max_bits)


@contained("simhash-labels")
def link_components(points: DataFrame, max_bits: int = MAX_BITS, bands: int = BANDS) -> DataFrame:
    """(fp, label) for distinct points (fp): label is the smallest fp reachable over links of at most max_bits.

    The candidates of a point are about one in 100,000 of all points; more bands make them
    fewer and the cells more (10 bands: 210 cells, one in a million).
    """
    if 64 // bands % 2 or max_bits >= bands:
        raise ValueError("bands must be whole segments and more than the bits that differ")
    by_cell = W.partitionBy("cell")
    near_hub = (
        _cells(points, max_bits, bands)
        .withColumn("hub", F.min("fp").over(by_cell))
        .where((F.col("fp") != F.col("hub")) & _within(F.col("fp"), F.col("hub"), max_bits))
        .select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    )
    first = components(near_hub)
    labelled = points.join(first.select(F.col("node").alias("fp"), "label"), "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))
    labelled = _cells(materialize(labelled, "simhash-labelled"), max_bits, bands).withColumn("main", F.min("label").over(by_cell))
    # of two points with different labels one at least has not the least label of the cell
    left = labelled.where("label <> main").select("cell", "main", F.col("fp").alias("fa"), F.col("label").alias("la"))
    right = labelled.select("cell", F.col("fp").alias("fb"), F.col("label").alias("lb"))
    # Spark takes exploded rows to be as few as those they come from, and would broadcast them
    links = (
        left.join(right.hint("merge"), "cell")
        .where("la <> lb and (lb = main or fa < fb)")
        .where(_within(F.col("fa"), F.col("fb"), max_bits))
        .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b"))
    )
    second = components(links)
    # labels that were linked once more: their points follow, hot labels apart
    moved = materialize(first.join(second.select(F.col("node").alias("label")), "label", "left_semi"), "simhash-moved")
    moved = attach(moved, second.select(F.col("node").alias("label"), F.col("label").alias("root")), "label")
    alone = second.join(first.select("node"), "node", "left_anti").select("node", F.col("label").alias("root"))
    found = moved.select("node", "root").unionByName(alone)
    labels = first.join(found, "node", "full").select(F.col("node").alias("fp"), F.coalesce("root", "label").alias("label"))
    return points.join(labels, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id): the smallest key reachable over links, itself included."""
    prints = materialize(fingerprints(docs, shingle, key, text), "simhash-prints")
    points = prints.groupBy("fp").agg(F.min(key).alias("_least"))
    labels = link_components(prints.select("fp").distinct(), max_bits)
    of_point = materialize(points.join(labels, "fp"), "simhash-of-point")
    least = materialize(of_point.groupBy("label").agg(F.min("_least").alias("component_id")), "simhash-least")
    resolved = materialize(attach(of_point, least, "label").select("fp", "component_id"), "simhash-resolved")
    return attach(prints, resolved, "fp").select(key, "fp", "component_id")


def near_duplicate_report(docs: DataFrame) -> DataFrame:
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
