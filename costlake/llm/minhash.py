"""Near copies: texts whose sets of five-word shingles share LEAST = 4/5 of their union, compared exactly.

A text is the set of its five-word shingles, hashed to 64 bits. Two near copies of n shingles
and more share c = 4/5 n of them at least, so that of the n - c + k smallest hashes of each
at least k are among those of the other. That tells which texts may have a near copy at all:
those of which k = n / 20 of these hashes, one at least, occur among those of another text.
The others, say texts with a few lines in common, are left out before anything is compared,
and then those of which fewer than 4/5 n of all shingles occur in the texts that are left.
No near copy is missed by either. Equal texts are one node from the start.

Candidates come from the SimHash operator first: texts in one component of its links are
compared with the component's smallest text. Its 4 bits of 64 reach few pairs at a similarity
of 0.8 (about 10 bits differ there, up to 14), and a radius that reaches them would take in a
pair of 300,000 random ones. Then buckets of minima join most others at little cost: a set has
BANDS buckets, each made of ROWS minima; two sets with similarity s share a bucket with
probability 1 - (1 - s**ROWS)**BANDS. What neither proposes is left to the last step, which is exact.

Comparisons go in steps, each of which leaves out pairs that are in one component already:
SimHash links, the members of each bucket with its smallest node, then with a node that a
hash picks bucket by bucket. So a large group of near copies gives about as many comparisons as
it has members. All other pairs come from a prefix filter: of the shingles that a text shares
with other components, rarest first, one of the first m - 4/5 n + 1 of its m is among the
first ones of each near copy. Two texts that meet in a shingle are a pair only if, from it
on, each has as many shared shingles left as both must have in common, which holds for the
first one that near copies share. Each text meets the first text of each of these shingles, then,
with the components joined, all others.

Defined cases: a null text counts as empty; a text of fewer words than a shingle has one
shingle, the whole text; a very long text is hashed whole; letter case (ASCII) and white
space do not count; of a group the row with the smallest key stays, of equal keys the one
with the smallest hash of its text, of equal rows one, and a row without a key only if no
row of the group has one; an empty table gives an empty result; other columns of the input
are left alone.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import map_slices
from .components import LEAST_HOT, MOST_HOT, attach, components
from .scratch import contained, materialize
from . import simhash
from .simhash import shingle_hashes

SHINGLE, ROWS, BANDS = 5, 7, 48
#: Near copies share at least this part of their shingles, as numerator and denominator.
LEAST = (4, 5)
#: Shingles of a text that are permuted at once.
BLOCK = 512
#: Of so many shingles one more is shared by the smallest hashes of near copies that are looked at.
EXTRA = 20


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and summands of the ROWS * BANDS permutations of 64 bits."""
    drawn = np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "big"), 11) for i in range(2 * ROWS * BANDS)], dtype=np.uint64)
    return drawn[::2] | np.uint64(1), drawn[1::2]


def buckets(grams: np.ndarray, factors: np.ndarray, summands: np.ndarray) -> list[int]:
    """The set's bucket of each band, as signed longs that differ between bands."""
    least = None
    for at in range(0, len(grams), BLOCK):
        found = (grams[at : at + BLOCK, None] * factors + summands).min(axis=0)
        least = found if least is None else np.minimum(least, found)
    raw = least.reshape(BANDS, ROWS)
    digests = [xxhash.xxh64_intdigest(raw[band].tobytes(), band) for band in range(BANDS)]
    return np.array(digests, dtype=np.uint64).view(np.int64).tolist()


def node_of(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    h = xxhash.xxh64_intdigest(b" ".join(words), 42)
    return h - (1 << 64) if h >> 63 else h


def _hash_of_text(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def smallest(grams: np.ndarray) -> np.ndarray:
    """Of the sorted hashes of a set the first: two near copies share n // EXTRA of these, and one at least."""
    more, all_of = LEAST
    n = len(grams)
    return grams[: n - (more * n + all_of - 1) // all_of + max(1, n // EXTRA)]


def hashed(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(key, raw, node, n, fp, grams): raw is a hash of the text, node of its words, n the number of distinct shingles, fp the fingerprint.

    grams are the smallest hashes of the set, once a task for each node, else none.
    """
    kind = dict(docs.select(key).dtypes)[key].replace("bigint", "long")

    def make():
        seen: set[int] = set()

        def first(node: int, grams: np.ndarray) -> np.ndarray:
            if node in seen:
                return grams[:0].view(np.int64)
            seen.add(node)
            return smallest(grams).view(np.int64)

        def work(ids, raw, texts):
            hashes = [shingle_hashes(t, shingle) for t in texts]
            prints = [simhash.signed(simhash.fingerprint_of(t, shingle, h)) for t, h in zip(texts, hashes)]
            sets = [np.unique(np.array(h, dtype=np.uint64)) for h in hashes]
            nodes = [node_of(t) for t in texts]
            return {key: ids, "raw": raw, "node": nodes, "n": [len(g) for g in sets], "fp": prints, "grams": [first(x, g) for x, g in zip(nodes, sets)]}

        return work

    return map_slices(docs.select(key, _hash_of_text(text), text), make, f"{key} {kind}, raw long, node long, n long, fp long, grams array<long>")


def meeting(rows: DataFrame) -> DataFrame:
    """(node): those of rows, as hashed() gives them, that may have a near copy, and all that have one."""
    same = W.partitionBy("gram")
    grams = rows.select("node", F.explode("grams").alias("gram")).withColumn("_shared", F.min("node").over(same) != F.max("node").over(same))
    shared = grams.where("_shared").dropDuplicates(["node", "gram"]).groupBy("node").agg(F.count("*").alias("m"))
    sizes = rows.groupBy("node").agg(F.min("n").alias("n"))
    return shared.join(sizes, "node").where(F.col("m") >= F.greatest(F.lit(1), F.expr(f"n div {EXTRA}"))).select("node")


@contained("minhash-rows")
def marked_rows(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(key, raw, node, n, fp, near) for docs: near says whether the text may have a near copy."""
    rows = materialize(hashed(docs, shingle, key, text), "minhash-hashed")
    near = materialize(meeting(rows).withColumn("near", F.lit(True)), "minhash-meeting")
    return rows.drop("grams").join(near, "node", "left").withColumn("near", F.coalesce("near", F.lit(False)))


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, grams, buckets) of texts, a table of one column: grams are the distinct shingles' hashes."""

    def make():
        factors, summands = permutations()

        def work(texts):
            sets = [np.unique(np.array(shingle_hashes(t, shingle), dtype=np.uint64)) for t in texts]
            return {"node": [node_of(t) for t in texts], "grams": [g.view(np.int64) for g in sets], "buckets": [buckets(g, factors, summands) for g in sets]}

        return work

    return map_slices(texts, make, "node long, grams array<long>, buckets array<long>")


def crowded(pairs: DataFrame, x: str) -> DataFrame:
    """(x, _of_x): the values of x that are in very many of the stored pairs, MOST_HOT at most, and the parts they are dealt to.

    The parts are fewer than 2 * MOST_HOT in all, and no part has more than one in MOST_HOT of the pairs.
    """
    counts = pairs.groupBy(x).agg(F.count("*").alias("_n"))
    limit = max(LEAST_HOT, pairs.count() // MOST_HOT)
    return materialize(counts.where(F.col("_n") > limit).select(x, F.ceil(F.col("_n") / limit).cast("int").alias(f"_of_{x}")), "minhash-crowded")


def with_set(pairs: DataFrame, sets: DataFrame, crowd: DataFrame, x: str, other: str) -> DataFrame:
    """pairs with the column _g_x, the set of x; pairs of a crowded x are dealt by their other end to copies of its set."""
    parts = F.coalesce(f"_of_{x}", F.lit(1))
    left = pairs.join(F.broadcast(crowd), x, "left").withColumn("_part", F.pmod(F.xxhash64(other), parts).cast("int"))
    copies = sets.select(F.col("node").alias(x), F.col("grams").alias(f"_g_{x}")).join(F.broadcast(crowd), x, "left")
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return left.drop(f"_of_{x}").join(copies.drop(f"_of_{x}"), [x, "_part"]).drop("_part")


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): the rows of pairs whose nodes' sets (node, grams) are near copies."""
    more, all_of = LEAST
    pairs = materialize(pairs, "minhash-pairs")
    both = with_set(with_set(pairs, sets, crowded(pairs, "a"), "a", "b"), sets, crowded(pairs, "b"), "b", "a")
    both = both.withColumn("_shared", F.size(F.array_intersect("_g_a", "_g_b")))
    return both.where(all_of * F.col("_shared") >= more * (F.size("_g_a") + F.size("_g_b") - F.col("_shared"))).select("a", "b")


@contained("minhash-proposed")
def proposed(rows: DataFrame) -> DataFrame:
    """(a, b): the nodes of each component of the SimHash operator with its smallest node."""
    of_print = rows.select("node", "fp").distinct()
    labels = simhash.link_components(rows.select("fp").distinct())
    labelled = materialize(attach(materialize(of_print, "minhash-nodes"), labels, "fp").select("node", "label"), "minhash-of-print")
    least = materialize(labelled.groupBy("label").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1"), "minhash-least")
    return attach(labelled, least, "label", "n").where("a != node").select("a", F.col("node").alias("b"))


def both_in(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    return pairs.join(nodes.select(F.col("node").alias("a")), "a", "left_semi").join(nodes.select(F.col("node").alias("b")), "b", "left_semi")


def _least_shared(n: str = "n") -> Column:
    """Shingles that a set of n must share with a near copy."""
    more, all_of = LEAST
    return F.expr(f"({more} * {n} + {all_of - 1}) div {all_of}")


def viable(sets: DataFrame) -> DataFrame:
    """(node): those of sets (node, grams) that can have a near copy among the others, by the number of their grams that occur there.

    Here and below exploded rows are sorted for joins: Spark takes them to be as few as the rows they come from, and would broadcast them.
    """
    grams = sets.select("node", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count("*").alias("_df")).where("_df > 1").select("gram")
    return grams.join(often.hint("merge"), "gram").groupBy("node", "n").agg(F.count("*").alias("m")).where(F.col("m") >= _least_shared()).select("node")


def prefixes(sets: DataFrame) -> DataFrame:
    """(node, label, n, gram, left) for sets (node, grams, label): two sets with different labels that are near copies have a gram in common here.

    Of the grams that a set shares with other labels, rarest first, all but the last that it
    must share with a near copy, save one; left is their number from this gram on.
    """
    grams = sets.select("node", "label", F.size("grams").alias("n"), F.explode("grams").alias("gram"))
    crossing = grams.groupBy("gram").agg(F.count("*").alias("df"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("gram", "df")
    own = grams.join(crossing.hint("merge"), "gram").groupBy("node", "label", "n").agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("c"))
    kept = own.withColumn("m", F.size("c")).where(F.col("m") >= _least_shared()).withColumn("c", F.slice("c", F.lit(1), (F.size("c") - _least_shared() + 1).cast("int")))
    placed = kept.select("node", "label", "n", "m", F.posexplode("c.gram").alias("at", "gram"))
    return materialize(placed.select("node", "label", "n", "gram", (F.col("m") - F.col("at")).alias("left")), "minhash-prefixes")


def _pairs(rows: DataFrame) -> DataFrame:
    """(a, b) of rows whose two sides have sizes of near copies and enough grams left, if the row's gram is the first that both have."""
    more, all_of = LEAST
    sizes = (all_of * F.col("n_a") >= more * F.col("n_b")) & (all_of * F.col("n_b") >= more * F.col("n_a"))
    enough = (more + all_of) * F.least("left_a", "left_b") >= more * (F.col("n_a") + F.col("n_b"))
    return rows.where(sizes & enough).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def _side(prefix: DataFrame, x: str) -> DataFrame:
    return prefix.select("gram", *(F.col(c).alias(f"{c}_{x}") for c in ("node", "label", "n", "left")))


def to_hubs(sets: DataFrame) -> DataFrame:
    """(a, b): each set with the first set, by label, of each gram of its prefix; at most as many as there are grams."""
    prefix = prefixes(sets)
    sides = ("label", "node", "n", "left")
    hub = prefix.groupBy("gram").agg(F.min(F.struct(*sides)).alias("h")).select("gram", *(F.col(f"h.{c}").alias(f"{c}_b") for c in sides))
    return _pairs(_side(prefix, "a").join(hub.hint("merge"), "gram").where("label_a <> label_b"))


def across(sets: DataFrame) -> DataFrame:
    """(a, b): pairs of sets (node, grams, label) with different labels that may be near copies, and all that are."""
    prefix = prefixes(sets)
    return _pairs(_side(prefix, "a").join(_side(prefix, "b").hint("merge"), "gram").where("label_a < label_b"))


@contained("minhash-labels")
def link_components(rows: DataFrame, docs: DataFrame, shingle: int, text: str) -> DataFrame:
    """(node, label) for the nodes of rows, as marked_rows() gives them for docs, that have near copies: label is the smallest node reachable."""
    rows = rows.where("near")
    printed = proposed(rows)
    wanted = rows.groupBy("node").agg(F.min("raw").alias("_raw"))  # equal texts meet as one row a task
    texts = docs.select(_hash_of_text(text).alias("_raw"), F.col(text).alias("_text")).join(wanted.select("_raw"), "_raw", "left_semi")
    wanted = materialize(shingle_sets(texts.dropDuplicates(["_raw"]).select("_text"), shingle), "minhash-sets")
    able = materialize(viable(wanted), "minhash-viable")
    wanted = materialize(wanted.join(able, "node", "left_semi"), "minhash-sets")
    printed = materialize(both_in(printed, able), "minhash-proposed")
    own = materialize(wanted.select("node", F.explode("buckets").alias("bucket")), "minhash-buckets")
    picked = F.col("node").bitwiseXOR(F.col("bucket"))  # from it and the bucket comes the node
    shared = (
        own.groupBy("bucket")
        .agg(F.count("*").alias("_of"), F.min("node").alias("_least"), F.min(picked).alias("_picked"))
        .where("_of > 1")
        .select("bucket", "_of", "_least", F.col("_picked").bitwiseXOR(F.col("bucket")).alias("_picked"))
    )
    shared = materialize(shared, "minhash-shared")
    members = materialize(attach(own, shared.select("bucket", "_of"), "bucket", "_of").drop("_of"), "minhash-members")

    def labelled(links: DataFrame, hub: str) -> tuple[DataFrame, DataFrame]:
        """The components of links, and the members with their label, their bucket's hub and its label."""
        found = components(links)
        hubs = shared.join(found.select(F.col("node").alias(hub), F.col("label").alias("main")), hub, "left")
        hubs = materialize(hubs.select("bucket", "_of", F.col(hub).alias("hub"), F.coalesce("main", hub).alias("main")), "minhash-mains")
        own = members.join(found, "node", "left").withColumn("label", F.coalesce("label", "node"))
        return found, materialize(attach(materialize(own, "minhash-own"), hubs, "bucket", "_of").drop("_of"), "minhash-labelled")

    links = materialize(similar(printed, wanted), "minhash-links")
    for hub in ("_least", "_picked"):
        _, rest = labelled(links, hub)
        pairs = rest.where("label != main").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
        links = materialize(links.union(similar(pairs, wanted)), "minhash-links")
    first = components(links)
    marked = lambda: wanted.join(first, "node", "left").withColumn("label", F.coalesce("label", "node"))
    links = materialize(links.union(similar(to_hubs(marked()), wanted)), "minhash-links")
    first = components(links)
    others = across(marked())
    found = similar(others, wanted)
    label_of = lambda c, n: first.select(F.col("node").alias(c), F.col("label").alias(n))
    between = found.join(label_of("a", "la"), "a", "left").join(label_of("b", "lb"), "b", "left")
    between = between.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct()
    second = components(between)
    ends = first.union(second.join(first, "node", "left_anti"))
    moved = second.select(F.col("node").alias("_first"), F.col("label").alias("_root"))
    ends = materialize(ends.select("node", F.col("label").alias("_first")), "minhash-ends")
    changed = attach(materialize(ends.join(moved.select("_first"), "_first", "left_semi"), "minhash-moved"), moved, "_first")
    return changed.select("node", F.col("_root").alias("label")).union(
        ends.join(changed.select("node"), "node", "left_anti").select("node", F.col("_first").alias("label"))
    )


@contained("minhash-kept")
def _kept(docs: DataFrame, shingle: int, key: str, text: str) -> DataFrame:
    """(_key, _raw, _rows) of the rows that stay: key, hash of the text, and the number of rows that have both."""
    rows = marked_rows(docs, shingle, key, text)
    labels = link_components(rows, docs, shingle, text)
    # a row's place: nulls last, then by key and text; minima are taken before any shuffle
    place = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("raw").alias("raw"))).alias("place")
    nodes = rows.groupBy("node").agg(place).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    kept = nodes.groupBy("label").agg(F.min("place").alias("place")).select(F.col("place.key").alias("_key"), F.col("place.raw").alias("_raw"))
    times = rows.groupBy(F.col(key).alias("_k"), F.col("raw").alias("_r")).agg(F.count("*").alias("_rows"))
    same = F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_raw") == F.col("_r"))
    return kept.join(times, same).select("_key", "_raw", "_rows")


def keep_one_of_each(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of docs for each component: the smallest key, then the smallest hash of the text; nulls last, equal rows once."""
    kept = _kept(docs, shingle, key, text)

    def rows_of(kept: DataFrame) -> DataFrame:
        same = docs[key].eqNullSafe(kept["_key"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == kept["_raw"])
        return docs.join(kept, same, "left_semi")

    # only rows that occur more than once are shuffled once more
    return rows_of(kept.where("_rows = 1")).union(rows_of(kept.where("_rows > 1")).dropDuplicates([key, text]))
