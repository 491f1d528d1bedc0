"""Sharding by a keyed Feistel permutation of global row numbers, with cycle walking.

Rows are numbered 0 to N-1 by (bucket of a hash of the key, key): each bucket is numbered
in parallel and starts where the buckets before it end. The permutation of the number
gives shard = value mod shards and slot = value div shards, so that anyone can compute
where a row went from its number alone, shard sizes differ by one at most and slots have
no gaps. SQL functions only; only narrow columns are shuffled, never the text.

Defined cases: a null text has size 1 and a checksum of the empty string; a very long text
is measured where it is read and goes nowhere; a null key is
numbered like any other; rows that repeat a key are ordered by size and checksum, and if
these agree too they are alike and share out their places; an empty table gives an empty
result; other columns of the input, whatever their names, are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS, SEED, ROUNDS = 8, 20240229, 6
#: Rows a bucket holds on average; BUCKETS bounds the table of bucket counts.
ROWS_A_BUCKET, BUCKETS = 1_000_000, 65_536
#: Steps of the walk. Each leaves the range with a chance of 3 in 4 at most.
STEPS = 160


def numbered(rows: DataFrame, key: str, then: list[str], total: int) -> DataFrame:
    """rows with _row: the global number, long."""
    buckets = max(16, min(BUCKETS, total // ROWS_A_BUCKET * 2))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key), *(F.col(c) for c in then)), F.lit(buckets)))
    sizes = dealt.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = sizes.select(
        "_bucket", (F.sum("_size").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")).alias("_before")
    )
    local = F.row_number().over(W.partitionBy("_bucket").orderBy(F.col(key), *(F.col(c) for c in then)))
    return dealt.withColumn("_local", local).join(F.broadcast(before), "_bucket").withColumn("_row", F.col("_before") + F.col("_local") - 1).drop(
        "_bucket", "_before", "_local"
    )


def permuted(row: Column, total: int, seed: int = SEED) -> Column:
    """A permutation of 0..total-1: a balanced Feistel network on the least even number of bits, walked until in range."""
    half = max(1, ((max(total, 2) - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    keys = F.array(*(F.lit(seed + i).cast("long") for i in range(ROUNDS)))

    def network(v: Column) -> Column:
        start = F.struct(F.shiftrightunsigned(v, half).alias("l"), v.bitwiseAND(F.lit(mask).cast("long")).alias("r"))

        def round_(s: Column, k: Column) -> Column:
            mixed = F.xxhash64(k, s["r"]).bitwiseAND(F.lit(mask).cast("long"))
            return F.struct(s["r"].alias("l"), s["l"].bitwiseXOR(mixed).alias("r"))

        return F.aggregate(keys, start, round_, lambda s: F.shiftleft(s["l"], half).bitwiseOR(s["r"]))

    limit = F.lit(total).cast("long")
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(STEPS)), network(row), lambda v, _: F.when(v < limit, v).otherwise(network(v))
    )
    return F.when(walked < limit, walked).otherwise(F.raise_error(F.lit("the walk did not end")).cast("long"))


def shard_rows(rows: DataFrame, key: str, then: list[str], shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """rows with shard (int) and slot (long)."""
    total = rows.count()
    placed = numbered(rows, key, then, total).withColumn("_to", permuted(F.col("_row"), total, seed))
    return placed.select(
        *(F.col(f"`{c}`") for c in rows.columns),
        F.pmod("_to", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_to div {shards}").alias("slot"),
    )


def sharding_report(docs: DataFrame) -> DataFrame:
    """One row per document: size, checksum, law, shard, slot."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    return shard_rows(rows, "doc_id", ["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
