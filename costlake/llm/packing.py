"""Packing of token sequences by cutting-stock column generation.

A document's ids are cut at multiples of the capacity; what remains is a last, shorter
piece. The histogram of piece lengths, in classes of GRAIN tokens, has a fixed number of
classes whatever the corpus. A linear program over patterns (how many pieces of each
class share a sequence) is solved by column generation: its dual prices go into a
knapsack, solved by dynamic programming, whose best pattern enters the basis. The
rounded patterns are then handed out: pieces are ranked within their class, and a piece's
rank decides its sequence by arithmetic on a small table of intervals. What rounding
leaves over, a number of pieces bounded by the classes, is packed first-fit decreasing.

Only the histogram reaches the driver. Ranks are counted in hashed parts of each class,
so a class that holds most pieces is ranked by many tasks.

Defined cases: a null text counts as empty, that is, the end id alone; a very long text
is encoded whole and cut into as many pieces as it takes; empty texts and repeated rows
are packed like any other (a repeated key gives repeated pieces); pieces of one length
class are interchangeable, their ranks follow key, start and checksum; an empty table
gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .arrowmap import map_slices
from .scratch import materialize

CAPACITY, GRAIN, END_ID = 2048, 8, 1
#: Tokenizer as ranks; its ids are those of the same vocabulary in the tokenizers library (tested).
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}
#: Pieces ranked by one task on average.
PIECES_A_PART = 500_000
#: Parts of each class at least: a class that most pieces fall in spreads over so many tasks.
LEAST_PARTS = 64
Pattern = tuple[tuple[int, int], ...]


# White space as the tokenizer's pattern has it.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A run of so much white space is split off before the tokenizer's pattern sees it, whose backtracking has a limit.
LONG_RUN = re.compile(f"(?<![{WHITE}])[{WHITE}]{{2000,}}+")


@cache
def _encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of a text. The pattern takes a run of white space without its last character, or whole at the end of
    the text and before a special token, as one word; long runs are encoded as that word by themselves."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    words = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)
    one_word = tiktoken.Encoding("run", pat_str="(?s).+", mergeable_ranks=ranks, special_tokens={})
    special = tuple(SPECIAL)

    def encode(text: str) -> np.ndarray:
        if len(text) < 2000:
            return words.encode_to_numpy(text, allowed_special="all")
        parts, at = [], 0
        for run in LONG_RUN.finditer(text):
            end = run.end()
            stop = end if end == len(text) or text.startswith(special, end) else end - 1
            parts.append(words.encode_to_numpy(text[at : run.start()], allowed_special="all"))
            parts.append(one_word.encode_to_numpy(text[run.start() : stop]))
            at = stop
        parts.append(words.encode_to_numpy(text[at:], allowed_special="all"))
        return np.concatenate(parts)

    return encode


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), one row per piece of at most capacity ids; with_ids adds them as an array."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(RANKS)

    def make():
        encode = _encoder(path)

        def work(keys, texts):
            out = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": [], "ids": []}
            for key, text in zip(keys, texts):
                tokens = np.append(encode(text or "").astype("<u4"), np.uint32(END_ID)).astype("<u4")
                raw, n = tokens.tobytes(), len(tokens)
                for start in range(0, n, capacity):
                    end = min(n, start + capacity)
                    out["doc_id"].append(key)
                    out["start"].append(start)
                    out["length"].append(end - start)
                    out["ids_crc32"].append(zlib.crc32(raw[4 * start : 4 * end]))
                    out["doc_tokens"].append(n)
                    if with_ids:
                        out["ids"].append(tokens[start:end].astype(np.int32))
            return out

        return work

    return map_slices(docs.select("doc_id", "text"), make, PIECES + (", ids array<int>" if with_ids else ""))


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack over sizes 1..len(prices): the most valuable pattern that fits, by dynamic programming on the room used."""
    m = len(prices)
    value = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, dtype=np.int64)
    for room in range(1, capacity + 1):
        most = min(m, room)
        # value[room - size] for sizes 1..most
        got = value[room - most : room][::-1] + prices[:most]
        size = int(np.argmax(got))
        if got[size] > value[room - 1] + 1e-12:
            value[room], choice[room] = got[size], size + 1
        else:
            value[room] = value[room - 1]
    pattern = np.zeros(m)
    room = capacity
    while room > 0:
        if choice[room]:
            pattern[choice[room] - 1] += 1
            room -= choice[room]
        else:
            room -= 1
    return float(value[capacity]), pattern


def solve_patterns(demand: np.ndarray, capacity: int, most_steps: int = 4000) -> list[tuple[float, np.ndarray]]:
    """Fewest sequences for demand[i] pieces of size i + 1, as a linear program: (times, pattern) of its basis.

    Revised simplex on the covering form; columns come from best_pattern, or are the
    surplus of a class whose price is negative. Any basis on the way is feasible, so the
    bound on steps costs padding at worst, never a piece.
    """
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    m = len(used)
    sizes = used + 1
    columns = np.diag((capacity // sizes).astype(float))
    cost = np.ones(m)
    inverse = np.diag(1.0 / np.diag(columns))
    x = inverse @ demand[used].astype(float)
    for _ in range(most_steps):
        prices = cost @ inverse
        worst = int(np.argmin(prices))
        if prices[worst] < -1e-9:
            entering, price = np.zeros(m), 0.0
            entering[worst] = -1.0
        else:
            full = np.zeros(int(sizes[-1]))
            full[used] = np.maximum(prices, 0)
            value, pattern = best_pattern(full, capacity)
            if value <= 1 + 1e-7:
                break
            entering, price = pattern[used], 1.0
        direction = inverse @ entering
        rows = np.flatnonzero(direction > 1e-9)
        if not len(rows):
            break
        ratios = x[rows] / direction[rows]
        out = rows[int(np.argmin(ratios))]
        step = x[out] / direction[out]
        x = np.maximum(x - step * direction, 0.0)
        x[out] = step
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        columns[:, out], cost[out] = entering, price
    found = []
    for j in range(m):
        if cost[j] and x[j] > 1e-9:
            pattern = np.zeros(len(demand))
            pattern[used] = columns[:, j]
            found.append((float(x[j]), pattern))
    return found


def plan_sequences(demand: np.ndarray, capacity: int) -> list[tuple[int, Pattern]]:
    """(times, ((size, pieces), ...)) that hold every piece of demand: rounded patterns, then first-fit decreasing."""
    left = demand.astype(np.int64).copy()
    plan: list[tuple[int, Pattern]] = []

    def take(times: int, pattern: np.ndarray) -> None:
        left[:] -= times * pattern.astype(np.int64)
        plan.append((times, tuple((int(i) + 1, int(pattern[i])) for i in np.flatnonzero(pattern)[::-1])))

    for times, pattern in solve_patterns(demand, capacity):
        own = np.flatnonzero(pattern)
        whole = min(int(times + 1e-6), *(int(left[i] // pattern[i]) for i in own)) if len(own) else 0
        if whole > 0:
            take(whole, pattern)
    rooms: list[int] = []
    held: list[dict[int, int]] = []
    for size in range(len(left), 0, -1):
        at = 0
        for _ in range(int(left[size - 1])):
            while at < len(rooms) and rooms[at] < size:
                at += 1
            if at == len(rooms):
                rooms.append(capacity)
                held.append({})
            rooms[at] -= size
            held[at][size] = held[at].get(size, 0) + 1
    plan += [(1, tuple(h.items())) for h in held]
    return plan


def assign(parts: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """parts with sequence_id and offset. parts has doc_id, start, length, ids_crc32; it is read several times and should be stored."""
    spark = parts.sparkSession
    units = capacity // grain
    classed = parts.withColumn("_size", F.ceil(F.col("length") / grain).cast("int"))
    histogram = {r["_size"]: r["n"] for r in classed.groupBy("_size").agg(F.count("*").alias("n")).collect()}
    demand = np.array([histogram.get(i + 1, 0) for i in range(units)])
    # of each class, intervals of ranks that share a pattern; their number is bounded by the classes
    intervals: dict[int, list[tuple[int, int, int, int, int]]] = {}
    base = 0
    for times, pattern in plan_sequences(demand, units):
        order = 0
        for size, each in pattern:
            own = intervals.setdefault(size, [])
            first = own[-1][1] if own else 0
            own.append((first, first + times * each, each, base, order))
            order += each
        base += times
    slots = spark.createDataFrame(
        list(intervals.items()), "_size int, _slots array<struct<from:long,to:long,each:long,base:long,order:long>>"
    )
    hashed = max(LEAST_PARTS, min(4096, int(demand.sum()) // PIECES_A_PART * 4))
    dealt = classed.withColumn("_part", F.pmod(F.xxhash64("doc_id", "start"), F.lit(hashed)).cast("int"))
    counts = dealt.groupBy("_size", "_part").agg(F.count("*").alias("_n"))
    before = counts.select(
        "_size", "_part", (F.sum("_n").over(W.partitionBy("_size").orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before")
    )
    local = F.row_number().over(W.partitionBy("_size", "_part").orderBy("doc_id", "start", "ids_crc32"))
    ranked = dealt.withColumn("_local", local).join(before, ["_size", "_part"]).withColumn("_rank", F.col("_before") + F.col("_local") - 1)
    mine = F.get(F.filter("_slots", lambda s: (F.col("_rank") >= s["from"]) & (F.col("_rank") < s["to"])), 0)
    placed = (
        ranked.join(F.broadcast(slots), "_size")
        .withColumn("_slot", mine)
        .withColumn("sequence_id", F.col("_slot.base") + F.expr("(_rank - _slot.from) div _slot.each"))
        .withColumn("_place", F.col("_slot.order") + (F.col("_rank") - F.col("_slot.from")) % F.col("_slot.each"))
    )
    within = W.partitionBy("sequence_id").orderBy("_place").rowsBetween(W.unboundedPreceding, 0)
    return placed.withColumn("offset", F.sum("length").over(within) - F.col("length")).select(*parts.columns, "sequence_id", "offset")


def pack(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; with_ids adds ids, the piece's tokens.

    Pieces are numbered as they are stored and placed without their ids, which join them last: ids are shuffled once.
    """
    found = pieces(docs, path, with_ids=with_ids)
    if not with_ids:
        return assign(materialize(found, "pieces"))
    stored = materialize(found.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    placed = materialize(assign(stored.drop("ids")), "placed")
    return placed.join(stored.select("_piece", "ids"), "_piece").drop("_piece")
