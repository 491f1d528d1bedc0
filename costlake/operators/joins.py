"""Joins by time validity and overlap, and null-safe comparison of two frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Rows of a price list or of run windows that are broadcast at most, and copies of larger windows.
FEW, SALTS = 10_000, 16


def few(df: DataFrame) -> bool:
    """Whether df has at most FEW rows; no more are counted."""
    return df.limit(FEW + 1).count() <= FEW


def spread(records: DataFrame, others: DataFrame) -> tuple[DataFrame, DataFrame]:
    """records with a random _salt, and others once for each as _p_salt."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_p_salt")
    return records.withColumn("_salt", F.pmod(F.xxhash64(*records.columns), F.lit(SALTS)).cast("int")), others.select("*", salts)


def dyadic(first: Column, last: Column, levels: int) -> Column:
    """The whole numbers first..last as nodes of a binary tree: array<struct<node, own>>.

    Own nodes are disjoint and make up the interval, two a level at most below the top one.
    The others are the nodes above them that reach beyond the interval. Two intervals that
    share a number n meet in exactly one node around n that one of them owns: the larger of
    the two own nodes around n.
    """
    found = []
    for level in range(levels + 1):
        node = lambda n, own, level=level: F.struct((n * 64 + level).alias("node"), F.lit(own).alias("own"))
        inside = lambda k: (-F.shiftright(-first, k), F.shiftright(last + 1, k) - 1)  # noqa: E731  first and last node within, at level k
        low, high = inside(level)
        nothing = F.array().cast("array<struct<node:bigint,own:boolean>>")
        if level == levels:
            found.append(F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), lambda n: node(n, True))).otherwise(nothing))
        else:
            above_low, above_high = inside(level + 1)
            found.append(F.when((low <= high) & (F.shiftright(low, 1) < above_low), F.array(node(low, True))).otherwise(nothing))
            at_end = (low <= high) & (F.shiftright(high, 1) > above_high) & ((high > low) | (F.shiftright(low, 1) >= above_low))
            found.append(F.when(at_end, F.array(node(high, True))).otherwise(nothing))
        if level:
            left, right = F.shiftright(first, level), F.shiftright(last, level)
            found.append(F.when((left < low) | (left > high), F.array(node(left, False))).otherwise(nothing))
            found.append(F.when((right != left) & ((right < low) | (right > high)), F.array(node(right, False))).otherwise(nothing))
    return F.concat(*found)


#: Seconds of the least node, and levels of the tree above it: for overlaps, which are dealt on both sides, and for validities.
UNIT, OVERLAP_LEVELS, VALIDITY_LEVELS = 3600, 10, 20
#: Where an open end is dealt to: the year 2200. Records behind it find no open price.
FOREVER = 7_258_118_400


def validity_join(
    records: DataFrame, prices: DataFrame, keys: list[str], at: str, valid_from: str, valid_to: str, until: str | None = None, how: str = "left"
) -> DataFrame:
    """records with the prices of equal keys that are valid at a time; a null end is open.

    until: the price must also cover the record up to there. Up to FEW prices, which are
    counted first, are broadcast. More of them are dealt to the tree nodes that make up
    their time, and a record looks into the nodes above its own time only: the versions of
    one key are neither copied nor all compared, and a hot key is spread over its times.
    """
    p = prices.select(*(F.col(c).alias(f"_k_{c}") for c in keys), *(c for c in prices.columns if c not in keys))
    within = (F.col(at) >= F.col(valid_from)) & (
        F.col(valid_to).isNull() | ((F.col(at) < F.col(valid_to)) & (F.col(until) <= F.col(valid_to) if until else F.lit(True)))
    )
    same = within
    for k in keys:
        same &= F.col(k) == F.col(f"_k_{k}")
    if few(p):
        return records.join(F.broadcast(p), same, how).drop(*(f"_k_{k}" for k in keys))
    hour = lambda c: F.floor(F.unix_timestamp(c) / UNIT)
    first = hour(valid_from)
    last = F.greatest(first, F.coalesce(hour(valid_to), F.lit(FOREVER // UNIT)))
    dealt = p.select("*", F.inline(dyadic(first, last, VALIDITY_LEVELS)).alias("_p_node", "_own")).where("_own").drop("_own")
    levels = F.transform(F.sequence(F.lit(0), F.lit(VALIDITY_LEVELS)), lambda k: F.call_function("shiftright", hour(at), k) * 64 + k)
    looking = records.where(F.col(at).isNotNull()).select("*", F.explode(levels).alias("_node"))
    matched = looking.join(dealt, same & (F.col("_node") == F.col("_p_node"))).drop("_node", "_p_node", *(f"_k_{k}" for k in keys))
    if how == "inner":
        return matched
    decisive = list(dict.fromkeys([*keys, at, *([until] if until else [])]))  # on these alone it depends whether a record has a price
    has = matched.select(*(F.col(c).alias(f"_h_{c}") for c in decisive)).distinct()
    equal = F.lit(True)
    for c in decisive:
        equal &= F.col(c) == F.col(f"_h_{c}")
    return matched.unionByName(records.join(has, equal, "left_anti"), allowMissingColumns=True)


def overlap_join(records: DataFrame, windows: DataFrame, start: str, end: str, window_start: str, window_end: str) -> DataFrame:
    """records with each window that overlaps them, and overlap_seconds, by an equality on tree nodes.

    Both sides become the nodes of their hours (dyadic), so that a window of a year is some 40
    rows; a pair counts in the one node around the begin of its overlap that either side
    owns, so it comes out once and no cross join is needed. Few windows are broadcast, more
    are repeated for the salts of the records.
    """
    seconds = lambda c: F.unix_timestamp(c)
    hours = lambda a, b: dyadic(F.floor(seconds(a) / UNIT), F.floor(F.greatest(seconds(a), seconds(b) - 1) / UNIT), OVERLAP_LEVELS)
    dealt = lambda df, a, b, own: df.where(F.col(b) > F.col(a)).select("*", F.inline(hours(a, b)).alias("_node", own))
    r, w = dealt(records, start, end, "_r_own"), dealt(windows, window_start, window_end, "_w_own")
    first, last = F.greatest(seconds(start), seconds(window_start)), F.least(seconds(end), seconds(window_end))
    if few(windows):
        pairs = r.join(F.broadcast(w), "_node")
    else:
        r, w = spread(r, w)
        pairs = r.join(w.withColumnRenamed("_p_salt", "_salt"), ["_node", "_salt"]).drop("_salt")
    level = F.pmod(F.col("_node"), F.lit(64)).cast("int")
    around = F.call_function("shiftright", F.floor(first / UNIT), level) == F.shiftright("_node", 6)
    return pairs.where((last > first) & (F.col("_r_own") | F.col("_w_own")) & around).withColumn("overlap_seconds", last - first).drop("_node", "_r_own", "_w_own")


def bag(of: list[str], when: Column | None = None) -> Column:
    """A digest of rows that does not depend on their order: the sum of their hashes. Nulls count by their place."""
    hashed = F.xxhash64(*(x for c in of for x in (F.col(c), F.col(c).isNull()))).cast("decimal(38,0)")
    return F.sum(hashed if when is None else F.when(when, hashed))


def differences(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys that only one side has, or whose values differ; nulls are equal to nulls, in keys too.

    One aggregate over both sides, so that nothing is multiplied: a key's rows are counted on
    each side (left_count, right_count). Keys with several rows on a side are compared by
    number and digest of their rows, and show the largest value of each column.
    """
    side = lambda df, name: df.select(*keys, *values, F.lit(name).alias("_side"))
    is_left, is_right = F.col("_side") == "left", F.col("_side") == "right"
    both = side(left, "left").unionByName(side(right, "right")).groupBy(*keys).agg(
        F.count_if(is_left).alias("left_count"),
        F.count_if(is_right).alias("right_count"),
        bag(values, is_left).alias("_left_bag"),
        bag(values, is_right).alias("_right_bag"),
        *(F.max(F.when(w, F.col(v))).alias(f"{n}_{v}") for v in values for n, w in (("left", is_left), ("right", is_right))),
    )
    changed = (F.col("left_count") != F.col("right_count")) | ~F.col("_left_bag").eqNullSafe(F.col("_right_bag"))
    for v in values:
        changed |= ~F.col(f"left_{v}").eqNullSafe(F.col(f"right_{v}"))
    return both.where(changed).select(
        *keys,
        F.when(F.col("left_count") == 0, "right only").when(F.col("right_count") == 0, "left only").otherwise("changed").alias("difference"),
        *(f"{n}_{v}" for v in values for n in ("left", "right")),
        "left_count",
        "right_count",
    )


def suspects(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], parts: int = 4096) -> DataFrame:
    """Parts of the keys' hash in which the sides differ in number or digest of their rows; parts rows at most.

    Each task passes on a row a part, so that equal tables are compared without moving their rows.
    """
    part = F.pmod(F.xxhash64(*keys), F.lit(parts)).alias("_part")
    digest = lambda df: df.groupBy(part).agg(F.count("*").alias("_rows"), bag([*keys, *values]).alias("_bag"))
    both = digest(left).unionByName(digest(right)).groupBy("_part", "_rows", "_bag").agg(F.count("*").alias("_sides"))
    return both.where("_sides = 1").select("_part").distinct()


def stored_differences(left: DataFrame, right: DataFrame, keys: list[str], values: list[str], parts: int = 4096) -> DataFrame:
    """differences() of stored tables: only rows in parts whose digests differ are brought together."""
    off = F.broadcast(suspects(left, right, keys, values, parts))  # parts rows at most
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    chosen = lambda df: df.withColumn("_part", part).join(off, "_part", "left_semi")
    return differences(chosen(left), chosen(right), keys, values)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with multiplicity, that only one side has, and which side."""
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
