"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes decides where a text may be cut, so that an insertion
moves boundaries only near itself. Chunking is normalised: up to the normal length a
boundary needs more zero bits, beyond it fewer, which narrows the spread of lengths. The
fingerprint is the set of chunk digests with their lengths; the share of a text's bytes
whose chunks occur in another measures how far the other contains it.

Each document is compared with its neighbour in descending key order. Documents are dealt
by key into ranges, each sorted by itself; the first document of a range is sent to the
range before it as well, so no task needs more than its own rows.

Defined cases: a null text counts as empty; the fingerprint of an empty text is empty,
and of two empty texts one contains the other fully, an empty one and another not at all;
a very long text is chunked whole, chunk after chunk; equal chunks of a text count once;
a null key comes last; rows that repeat a key follow each other by a hash of their text;
a single document is its own neighbour; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrowmap import ship, slices

WINDOW, LEAST, NORMAL, MOST = 32, 32, 96, 384
#: Zero bits that a boundary needs up to the normal length, and beyond it.
HARD_BITS, EASY_BITS = 8, 5
Chunks = dict[int, int]


def gear_table() -> np.ndarray:
    return np.array([xxhash.xxh32_intdigest(bytes([b]), 7) for b in range(256)], dtype=np.uint32)


def gear_hashes(data: bytes, table: np.ndarray) -> np.ndarray:
    """Hash at each byte: the table's values of the WINDOW bytes up to it, the k-th last shifted by k bits. By doubling."""
    h = table[np.frombuffer(data, dtype=np.uint8)]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def boundaries(data: bytes, sizes: list[int], table: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text; data holds the texts one after another.

    As no chunk is shorter than the window, no boundary depends on bytes before its chunk.
    A boundary never splits a UTF-8 sequence.
    """
    n = len(data)
    if not n:
        return [[] for _ in sizes]
    h = gear_hashes(data, table)
    easy = (h >> np.uint32(32 - EASY_BITS)) == 0
    raw = np.frombuffer(data, dtype=np.uint8)
    easy[:-1] &= (raw[1:] & 0xC0) != 0x80
    cuts = np.flatnonzero(easy)
    hard = ((h[cuts] >> np.uint32(32 - HARD_BITS)) == 0).tolist()
    places = (cuts + 1).tolist()
    out, at, k, count = [], 0, 0, len(places)
    for size in sizes:
        end, start, ends = at + size, at, []
        while start < end:
            cut = min(end, start + MOST)
            while k < count and places[k] < start + LEAST:
                k += 1
            j = k
            while j < count and places[j] < cut:
                if hard[j] or places[j] - start > NORMAL:
                    cut = places[j]
                    break
                j += 1
            if cut < end:
                while cut > start + 1 and raw[cut] & 0xC0 == 0x80:
                    cut -= 1
            ends.append(cut - at)
            start = cut
        out.append(ends)
        at = end
    return out


def chunk_sets(texts: list[bytes], table: np.ndarray) -> list[Chunks]:
    """Digest -> length of the chunks of each text."""
    digest = xxhash.xxh32_intdigest
    out = []
    for text, ends in zip(texts, boundaries(b"".join(texts), [len(t) for t in texts], table)):
        start, found = 0, {}
        for end in ends:
            found[digest(text[start:end])] = end - start
            start = end
        out.append(found)
    return out


def containment(a: Chunks, b: Chunks) -> float:
    """Share of a's length whose chunks are in b."""
    if not a:
        return 0.0 if b else 1.0
    return sum(n for d, n in a.items() if d in b) / sum(a.values())


def as_string(chunks: Chunks) -> str:
    return ",".join([f"{d:08x}:{n}" for d, n in sorted(chunks.items())])


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most key, by binary search; 0 for a null key."""
    if not bounds:
        return F.lit(0)
    table = F.array(*(F.lit(b).cast("long") for b in bounds))
    zero = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.shiftright(acc["low"] + acc["high"], 1)
        up = F.get(table, middle) <= key
        going = acc["low"] < acc["high"]
        return F.struct(
            F.when(going & up, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(going & ~up, middle).otherwise(acc["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.when(key.isNull(), 0).otherwise(F.aggregate(steps, zero, halve, lambda acc: acc["low"]))


def with_neighbours(rows: DataFrame, key: str, ranges: int) -> DataFrame:
    """rows in ranges of the key, each sorted descending; _range, and _copy for a row that only serves as a neighbour."""
    shares = [i / ranges for i in range(1, ranges)]
    found = rows.select(F.percentile_approx(key, shares, 10_000)).first()[0] if shares else None
    bounds = sorted(set(found or []))
    dealt = rows.withColumn("_range", _range_of(F.col(key), bounds))
    firsts = sorted(dealt.groupBy("_range").agg(F.max(key).alias("first")).collect(), reverse=True)
    to = {}
    for i, row in enumerate(firsts):  # the range before it in descending order; the last range gets the first of all
        to.setdefault((row["_range"], row["first"]), []).append(firsts[i - 1]["_range"])
    copies = F.array().cast("array<int>")
    if firsts:
        pairs = rows.sparkSession.createDataFrame(
            [(r, k, target) for (r, k), targets in to.items() for target in targets], f"_range int, _first {dict(rows.dtypes)[key]}, _target int"
        )
        # one row a range
        dealt = dealt.join(F.broadcast(pairs), (dealt["_range"] == pairs["_range"]) & dealt[key].eqNullSafe(F.col("_first")), "left").drop(
            pairs["_range"], "_first"
        )
        copies = F.when(F.col("_target").isNotNull(), F.array("_target")).otherwise(copies)
    own = F.struct(F.col("_range").alias("range"), F.lit(False).alias("copy"))
    sent = F.transform(copies, lambda t: F.struct(t.alias("range"), F.lit(True).alias("copy")))
    spread = dealt.select(*rows.columns, F.explode(F.concat(F.array(own), sent)).alias("_at"))
    placed = spread.select(*rows.columns, F.col("_at.range").alias("_range"), F.col("_at.copy").alias("_copy"))
    return placed.repartitionById(len(bounds) + 1, F.col("_range")).sortWithinPartitions(
        F.desc("_range"), "_copy", F.desc_nulls_last(key), F.xxhash64("text")
    )


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows are doc_id, text, _range, _copy; each but the copies is compared with the row after it."""
    table = gear_table()
    waiting = None  # the last row: (doc_id, text, chunks, range, copy)

    def rows(part: pa.RecordBatch):
        ids, texts, ranges, copies = (part.column(i).to_pylist() for i in range(4))
        texts = [t or "" for t in texts]
        chunks = chunk_sets([t.encode() for t in texts], table)
        return list(zip(ids, texts, chunks, ranges, copies))

    for batch in batches:
        for part in slices(batch):
            pairs = []
            for row in rows(part):
                if waiting is not None and not waiting[4] and waiting[3] == row[3]:
                    pairs.append((waiting, row))
                waiting = row
            edited = []
            for own, after in pairs:
                half = len(own[1]) // 2
                edited.append((own[1][: len(own[1]) - half] + after[1][:half]).encode())
            sets = chunk_sets(edited, table)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([own[0] for own, _ in pairs], pa.int64()),
                    "n_chars": pa.array([len(own[1]) for own, _ in pairs], pa.int64()),
                    "edited_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                    "fingerprint": pa.array([as_string(own[2]) for own, _ in pairs], pa.string()),
                    "edited_fingerprint": pa.array([as_string(s) for s in sets], pa.string()),
                    "near_edited": pa.array([containment(own[2], s) for (own, _), s in zip(pairs, sets)], pa.float64()),
                    "near_next": pa.array([containment(own[2], after[2]) for own, after in pairs], pa.float64()),
                }
            )


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of the text and of its edited form, and their likeness."""
    spark = docs.sparkSession
    ship(spark)
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return with_neighbours(docs.select("doc_id", "text"), "doc_id", ranges).mapInArrow(_compare, SCHEMA)
