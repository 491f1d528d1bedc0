"""Prefix trie of conversations by a skeleton of splitters and sorted shards.

A turn is a digest of its role and text, a conversation the string of its turns' digests, so
that byte order keeps the conversations of one prefix together. Splitters, quantiles of a
bounded sample by (path, conv_id), cut this order into shards of even size; copies of one
conversation are cut by their conv_id. A node lies within one shard unless its path is a
prefix of a splitter: the trie of the splitters' paths, the skeleton, is broadcast, and every
shard walks its sorted conversations once, finishing all other nodes with nothing but the
open path in memory. Of skeleton nodes each shard passes on a partial aggregate; these are
summed by node, and one pass from the last to the first (children follow their parents) gives
the rest. The digest of the conversations that end at a skeleton node needs their ids in
order; shards pass them on as joined chunks, which stream through a hash.

Texts are read once and never shuffled: a turn moves as 16 bytes and its size.

Defined cases: a null role or text counts as empty; rows without conv_id take no part; of a
conversation the turns without number come first, turns of one number (repeated rows too) are
ordered by their digests; the remainder conv_id % 5 has the sign of conv_id, as in SQL; a very
long text counts as its digest and size, a conversation of n turns is one row of 24 n bytes;
equal conversations share their nodes; a conversation without turns is a member of the root
alone; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import arrow_schema, ship
from .scratch import materialize

#: Turns of a shard on average, shards at most, sampled conversations for each shard.
TURNS_A_SHARD, MOST_SHARDS, SAMPLED = 20_000, 65_536, 8
#: Nodes of the skeleton at most; turns of a splitter at most, halved until the splitters together fit.
SKELETON, DEEPEST = 262_144, 4096
DIGEST = 16
#: Ids of a chunk, rows of an output batch.
CHUNK, ROWS = 8192, 16_384
NODES = "kind int, node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, shard long, seq long, ends string"
LOCAL, PARTIAL, ENDS = range(3)
NOBODY = hashlib.sha256(b"").hexdigest()


def paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) of every conversation by its own turns: digests in order, UTF-8 bytes of the texts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.octet_length(role), F.concat(role, text)), 256), 1, 2 * DIGEST))
    turn = F.struct(
        F.col("turn").isNotNull().alias("told"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    own = conversations.where(F.col("conv_id").isNotNull()).select("conv_id", turn.alias("_turn")).groupBy("conv_id").agg(F.array_sort(F.collect_list("_turn")).alias("_turns"))
    return own.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("_turns", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.transform("_turns", lambda t: t["size"]).alias("sizes"),
    )


def rebuild(own: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """own with the first h turns of each conversation c taken from conversation c - c % every; h = crc32(c) % most."""
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    heads = own.select(F.col("conv_id").alias("_base"), F.substring("path", 1, DIGEST * (most - 1)).alias("_path"), F.slice("sizes", 1, most - 1).alias("_sizes"))
    both = own.withColumn("_h", h).join(heads, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left")
    none = F.array().cast("array<bigint>")
    return both.select(
        "conv_id",
        F.concat(F.coalesce(F.substring("_path", F.lit(1), F.col("_h") * DIGEST), F.unhex(F.lit(""))), F.substring("path", F.col("_h") * DIGEST + 1, F.octet_length("path"))).alias("path"),
        F.concat(F.coalesce(F.slice("_sizes", F.lit(1), F.col("_h")), none), F.slice("sizes", F.col("_h") + 1, F.size("sizes"))).alias("sizes"),
    )


def splitters(stored: DataFrame, shards: int, deepest: int = DEEPEST, skeleton: int = SKELETON) -> list[tuple[bytes, int]]:
    """shards - 1 points of the order by (path, conv_id), fewer for fewer conversations; their paths have skeleton turns together at most."""
    if shards < 2:
        return []
    sample = stored.select(F.substring("path", 1, DIGEST * deepest).alias("path"), "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLED * shards)
    numbered = sample.withColumn("_n", F.row_number().over(W.orderBy("path", "conv_id")))  # a bounded sample
    chosen = materialize(numbered.where(F.col("_n") % SAMPLED == 0).select("path", "conv_id"), "splitters")
    depths = [deepest >> i for i in range(deepest.bit_length())]
    turns = F.octet_length("path") / DIGEST
    totals = chosen.agg(*(F.sum(F.least(turns, F.lit(d))) for d in depths)).first()
    depth = next((d for d, total in zip(depths, totals) if (total or 0) <= skeleton), 1)
    return sorted((bytes(r["path"]), r["conv_id"]) for r in chosen.select(F.substring("path", 1, DIGEST * depth).alias("path"), "conv_id").collect())


def skeleton_of(points: list[tuple[bytes, int]]) -> tuple[list[dict[bytes, int]], list[int], list[int]]:
    """The trie of the points' paths: children by digest, parent and depth of each node; node 0 is the root, a subtree follows its top."""
    children, parent, depth = [{}], [-1], [0]
    for path, _ in points:
        at = 0
        for i in range(0, len(path), DIGEST):
            step = path[i : i + DIGEST]
            if step not in children[at]:
                children[at][step] = len(children)
                children.append({})
                parent.append(at)
                depth.append(depth[at] + 1)
            at = children[at][step]
    return children, parent, depth


class _Node:
    __slots__ = ("bone", "size", "first", "n", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, bone: int, size: int):
        self.bone, self.size = bone, size
        self.first, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = None  # hash of a local node's ids, ids of a skeleton node's
        self.waiting: list[tuple] = []  # children whose parent's smallest member is not known yet


class Walk:
    """One pass over sorted conversations; out collects the rows of NODES."""

    def __init__(self, children: list[dict[bytes, int]]):
        self.bones, self.shard, self.path, self.open, self.out, self.seq = children, None, b"", [], [], 0

    def take(self, shard: int, path: bytes, conv_id: int, sizes: list[int]) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.path, self.open, self.seq = shard, b"", [_Node(0, 0)], 0
        shared = 0
        if path == self.path:
            shared = len(path)
        else:
            most = min(len(path), len(self.path))
            while shared < most and path[shared : shared + DIGEST] == self.path[shared : shared + DIGEST]:
                shared += DIGEST
        self._close(shared // DIGEST)
        for i in range(shared, len(path), DIGEST):
            bone = self.open[-1].bone
            self.open.append(_Node(self.bones[bone].get(path[i : i + DIGEST], -1) if bone >= 0 else -1, sizes[i // DIGEST]))
        self.path, top = path, self.open[-1]
        top.n += 1
        top.first = conv_id if top.first is None else min(top.first, conv_id)
        if top.bone < 0:
            if top.ends is None:
                top.ends = hashlib.sha256(str(conv_id).encode())
            else:
                top.ends.update(b",%d" % conv_id)
        else:
            if top.ends is None:
                top.ends = []
            top.ends.append(str(conv_id))
            if len(top.ends) >= CHUNK:
                self._pass_on(top)

    def _pass_on(self, node: _Node) -> None:
        self.out.append((ENDS, node.bone, *[None] * 8, self.shard, self.seq, ",".join(node.ends)))
        self.seq += 1
        node.ends = []

    def _close(self, depth: int) -> None:
        """Close all open nodes deeper than depth."""
        while len(self.open) > depth + 1:
            node, at = self.open.pop(), len(self.open)
            self._settle(node, at, self.open[-1])

    def _settle(self, node: _Node, depth: int, parent: _Node | None) -> None:
        if parent is not None:
            parent.n += node.n
            parent.first = node.first if parent.first is None else min(parent.first, node.first)
        if node.bone >= 0:
            if node.ends:
                self._pass_on(node)
            self.out.append((PARTIAL, node.bone, node.first, depth, None, node.n, node.children, node.leaves, node.saved, node.size, None, None, None))
            return
        saved = node.saved + (node.n - 1) * node.size
        leaves = node.leaves or 1
        for child in node.waiting:
            self.out.append((LOCAL, None, child[0], depth + 1, node.first, *child[1:5], None, None, None, child[5]))
        made = (node.first, node.n, node.children, leaves, saved, node.ends.hexdigest() if node.ends else NOBODY)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        if parent.bone < 0:
            parent.waiting.append(made)
        else:
            self.out.append((LOCAL, parent.bone, made[0], depth, None, *made[1:5], None, None, None, made[5]))

    def finish(self) -> None:
        if self.open:
            self._close(0)
            self._settle(self.open.pop(), 0, None)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _digests(chunks: DataFrame) -> DataFrame:
    """(node, ends_sha256) over chunks (node, shard, seq, ends), joined in order as they stream by."""
    schema = arrow_schema("node long, ends_sha256 string")

    def run(batches):
        node, digest, done = None, None, []
        for batch in batches:
            for at, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if at == node:
                    digest.update(b"," + ends.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ends.encode())
        if node is not None:
            done.append((node, digest.hexdigest()))
        if done:
            yield _batch(done, schema)

    return chunks.repartition("node").sortWithinPartitions("node", "shard", "seq").select("node", "ends").mapInArrow(run, "node long, ends_sha256 string")


def trie(stored: DataFrame, turns_a_shard: int = TURNS_A_SHARD, deepest: int = DEEPEST, skeleton: int = SKELETON) -> DataFrame:
    """One row a node of the trie over stored (conv_id, path, sizes); rows as conversation_trie gives."""
    spark = stored.sparkSession
    ship(spark)
    turns = stored.agg(F.sum(F.size("sizes"))).first()[0] or 0
    shards = max(1, min(MOST_SHARDS, -(-turns // turns_a_shard)))
    points = splitters(stored, shards, deepest, skeleton)
    children, parent, depth = skeleton_of(points)
    held, schema = spark.sparkContext.broadcast((points, children)), arrow_schema(NODES)
    dealt_fields = arrow_schema("shard int, path binary, conv_id long, sizes array<long>")

    def deal(batches):
        points = held.value[0]
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())
            shard = pa.array([bisect_right(points, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([shard, batch.column("path"), batch.column("conv_id"), batch.column("sizes")], schema=dealt_fields)

    def walk(batches):
        work = Walk(held.value[1])
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4))):
                work.take(*row)
            while len(work.out) >= ROWS:
                yield _batch(work.out[:ROWS], schema)
                del work.out[:ROWS]
        work.finish()
        for at in range(0, len(work.out), ROWS):
            yield _batch(work.out[at : at + ROWS], schema)

    dealt = stored.mapInArrow(deal, "shard int, path binary, conv_id long, sizes array<long>")
    sorted_ = dealt.repartition(len(points) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = materialize(sorted_.mapInArrow(walk, NODES), "nodes", by=["kind"])

    partial = found.where(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.min("conv_id").alias("first"), *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("size").alias("size")
    )
    ends = _digests(found.where(F.col("kind") == ENDS).select("node", "shard", "seq", "ends"))
    bones = _reduced(partial.join(ends, "node", "left").collect(), parent, depth)  # SKELETON rows at most
    result = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    of_skeleton = spark.createDataFrame(bones, f"node long, {result}")
    columns = of_skeleton.columns[1:]
    local = found.where(F.col("kind") == LOCAL).withColumnRenamed("ends", "ends_sha256").join(
        F.broadcast(of_skeleton.select("node", F.col("conv_id").alias("_first"))), "node", "left"
    )
    return local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_first")).select(*columns).unionByName(of_skeleton.select(*columns))


def _reduced(rows: list, parent: list[int], depth: list[int]) -> list[tuple]:
    """Rows of the skeleton's nodes from their summed partial aggregates, children before parents."""
    of = {r["node"]: r for r in rows}
    leaves, saved, below = ({i: 0 for i in of} for _ in range(3))
    made = []
    for i in sorted(of, reverse=True):
        r, up = of[i], parent[i]
        n_children = r["n_children"] + below[i]
        n_leaves = r["n_leaves"] + leaves[i] if n_children else 1
        total = r["saved_tokens"] + saved[i] + (r["n_convs"] - 1) * r["size"]
        if up >= 0:
            below[up] += 1
            leaves[up] += n_leaves
            saved[up] += total
        made.append((i, r["first"], depth[i], of[up]["first"] if up >= 0 else None, r["n_convs"], n_children, n_leaves, total, r["ends_sha256"] or NOBODY))
    return made


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row a node: smallest member, depth, parent's smallest member, members, children, leaves, saved tokens, digest of those that end there."""
    return trie(materialize(rebuild(materialize(paths(conversations), "conversations")), "rebuilt"))
