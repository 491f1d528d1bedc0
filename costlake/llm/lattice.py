"""Language-model scores from a lattice of subwords.

The pieces of a public vocabulary are a unigram model. A word's probability is the sum
over all its segmentations of the product of their pieces' probabilities, by a forward
recursion in log space; a text's is the product over its words and one end piece. The
vocabulary's own scores give each piece a start value by its rank; rounds of
expectation maximisation over the word counts of the whole training corpus (all
segmentations, forward and backward) weights them to the corpus.

Words are counted once, over all documents. The lattice is solved once a distinct word.
A document needs its words' values back: the HOT most frequent words are a table of fixed
size that goes to every task, the others are joined by word, so no join key is frequent.

Defined cases: a null text counts as empty, that is, one end token; a very long text is
split whole, a very long word has a lattice of its own length; words equally frequent
rank by their bytes, which decides the way they travel and not their value; a null key is not
learned from; repeated rows are scored each for itself; without training texts base
counts are 0 and pieces keep their start values; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowmap import ship, slices
from .scratch import materialize

VOCABULARY = "piece_bpe_32k.model"
HOT = 50_000
HELD_WORDS = 400_000
WORDS_A_BATCH = 4096
#: Weight of the start values, in pieces, beside the expected counts.
PRIOR = 1000.0
ROUNDS = 2
START, LN10 = "▁", math.log(10)
#: Polynomial hash of a string's code points modulo 2 ** 64; its upper 22 bits are a slot.
HASH_FACTOR, SLOT_SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(42)


def hash_of(text: str) -> int:
    h = 0
    for c in text:
        h = (h * int(HASH_FACTOR) + ord(c)) % (1 << 64)
    return h


class Vocabulary:
    """Pieces without capital A-Z, single bytes for what they don't cover, and the end of a text."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, int] = {}
        self.bytes = [0] * 256
        ranks: list[int] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = len(ranks)
            elif model.is_control(i) or model.is_unknown(i) or piece != piece.translate(_LOWER):
                continue
            else:
                self.pieces[piece] = len(ranks)
            ranks.append(int(-model.get_score(i)) if not model.is_byte(i) else model.get_piece_size())
        self.end = len(ranks)
        ranks.append(100)
        self.longest = max(map(len, self.pieces))
        hashed = sorted((hash_of(p), i) for p, i in self.pieces.items())
        self.hashes = np.array([h for h, _ in hashed], dtype=np.uint64)
        self.hashed_ids = np.array([i for _, i in hashed], dtype=np.int32)
        if len(np.unique(self.hashes)) < len(self.hashes):
            raise ValueError("two pieces share a hash")
        self.slots = np.zeros(1 << 22, dtype=bool)
        self.slots[self.hashes >> SLOT_SHIFT] = True
        start = 1.0 / (np.array(ranks, dtype=np.float64) + 2.0)
        self.start_values = start / start.sum()


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@cache
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Lattice:
    """Forward (and backward) sums over the segmentations of words, for many words of one length at a time."""

    def __init__(self, vocabulary: Vocabulary, shares: np.ndarray):
        self.v = vocabulary
        self.shares = shares
        self.log = np.log(shares)

    def _edges(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, list[int]]]]:
        """ids[word, start, length - 1] of pieces or -1; single characters without a piece as (word, start, byte ids).

        All substrings of one length are hashed at once, each from the one shorter by a character.
        """
        count, n = len(words), len(words[0])
        width = min(n, self.v.longest)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).reshape(count, n).astype(np.uint64)
        ids = np.full((count, n, width), -1, dtype=np.int32)
        hashes = np.zeros((count, n), dtype=np.uint64)
        for length in range(1, width + 1):
            hashes = hashes[:, : n - length + 1] * HASH_FACTOR + codes[:, length - 1 :]
            w, s = np.nonzero(self.v.slots[hashes >> SLOT_SHIFT])
            if len(w):
                found = hashes[w, s]
                at = np.minimum(np.searchsorted(self.v.hashes, found), len(self.v.hashes) - 1)
                same = self.v.hashes[at] == found
                ids[w[same], s[same], length - 1] = self.v.hashed_ids[at[same]]
        spelled = [(w, s, [self.v.bytes[b] for b in words[w][s].encode()]) for w, s in np.argwhere(ids[:, :, 0] < 0).tolist()]
        return ids, spelled

    def _weights(self, ids: np.ndarray, spelled: list) -> np.ndarray:
        weights = np.where(ids >= 0, self.log[ids], -np.inf)
        for w, s, spelling in spelled:
            weights[w, s, 0] = sum(self.log[b] for b in spelling)
        return weights

    @staticmethod
    def _forward(weights: np.ndarray) -> np.ndarray:
        count, n, width = weights.shape
        alpha = np.full((n + 1, count), -np.inf)
        alpha[0] = 0.0
        for end in range(1, n + 1):
            terms = [alpha[end - k] + weights[:, end - k, k - 1] for k in range(1, min(end, width) + 1)]
            alpha[end] = np.logaddexp.reduce(terms, axis=0) if len(terms) > 1 else terms[0]
        return alpha

    def _grouped(self, words: list[str]) -> Iterator[tuple[list[int], list[str]]]:
        """Places and words of one length, so many that their table stays small."""
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, places in by_length.items():
            step = max(1, 2_000_000 // (n * min(n, self.v.longest)))
            for at in range(0, len(places), step):
                some = places[at : at + step]
                yield some, [words[i] for i in some]

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural log of each word's probability."""
        out = np.zeros(len(words))
        for places, some in self._grouped(words):
            out[places] = self._forward(self._weights(*self._edges(some)))[-1]
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected number of each piece if each word occurs counts times."""
        total = np.zeros(len(self.shares))
        for places, some in self._grouped(words):
            ids, spelled = self._edges(some)
            weights = self._weights(ids, spelled)
            alpha = self._forward(weights)
            count, n, width = weights.shape
            beta = np.full((n + 1, count), -np.inf)
            beta[n] = 0.0
            for start in range(n - 1, -1, -1):
                terms = [weights[:, start, k - 1] + beta[start + k] for k in range(1, min(n - start, width) + 1)]
                beta[start] = np.logaddexp.reduce(terms, axis=0) if len(terms) > 1 else terms[0]
            times = counts[places]
            used = np.zeros(weights.shape)
            for k in range(1, width + 1):
                at = np.arange(0, n - k + 1)
                used[:, at, k - 1] = np.exp(alpha[at].T + weights[:, at, k - 1] + beta[at + k].T - alpha[n][:, None]) * times[:, None]
            known = ids >= 0
            total += np.bincount(ids[known], weights=used[known], minlength=len(total))
            for w, s, spelling in spelled:
                for b in spelling:
                    total[b] += used[w, s, 0]
        return total


def learned_from(key, modulus: int = 7, remainder: int = 2) -> bool:
    return key is not None and zlib.crc32(str(key).encode()) % modulus != remainder


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, learned, seen) of a task's documents; the end of a text is the null word."""
    learned, seen, ends = Counter(), Counter(), [0, 0]

    def flush(with_ends: bool) -> pa.RecordBatch:
        words = list(learned.keys() | seen.keys())
        first, second = [learned[w] for w in words], [seen[w] for w in words]
        if with_ends:
            words.append(None)
            first.append(ends[0])
            second.append(ends[1])
        learned.clear()
        seen.clear()
        return pa.RecordBatch.from_pydict(
            {"word": pa.array(words, pa.binary()), "learned": pa.array(first, pa.int64()), "seen": pa.array(second, pa.int64())}
        )

    for batch in batches:
        for part in slices(batch):
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                own = learned_from(key)
                (learned if own else seen).update(_words(text))
                ends[0] += own
                ends[1] += not own
            if len(learned) + len(seen) > HELD_WORDS:
                yield flush(False)
    yield flush(True)


def count_words(docs: DataFrame) -> DataFrame:
    """(word, learned, seen): counts over training documents and over the others, in one shuffle of each task's sums."""
    ship(docs.sparkSession)
    counted = docs.select("doc_id", "text").mapInArrow(_count_words, "word binary, learned long, seen long")
    return counted.groupBy("word").agg(F.sum("learned").alias("learned"), F.sum("seen").alias("seen"))


def _as_pieces(word: bytes) -> str:
    return START + word.decode()


def fit(words: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Shares of the pieces: start values weighted to the training counts. At most a row a piece reaches the driver."""
    vocabulary = _vocabulary(path)
    shares = vocabulary.start_values
    ends = words.where("word is null").agg(F.sum("learned")).first()[0] or 0
    for _ in range(rounds):
        current = shares

        def expect(batches: Iterator[pa.RecordBatch], current=current) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(_vocabulary(path), current)
            total = np.zeros(len(current))
            for batch in batches:
                for at in range(0, batch.num_rows, WORDS_A_BATCH):
                    part = batch.slice(at, WORDS_A_BATCH)
                    total += lattice.expected([_as_pieces(w) for w in part.column(0).to_pylist()], part.column(1).to_numpy().astype(float))
            places = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(places, pa.int32()), "n": pa.array(total[places], pa.float64())})

        got = (
            words.where("word is not null and learned > 0").select("word", "learned").mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        )
        counts = PRIOR * vocabulary.start_values
        for row in got.collect():
            counts[row["piece"]] += row["n"]
        counts[vocabulary.end] += ends
        shares = counts / counts.sum()
    return shares


def with_scores(words: DataFrame, path: str, shares: np.ndarray) -> DataFrame:
    """words (but the null one) with log10, the word's log10 probability."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(_vocabulary(path), shares)
        for batch in batches:
            for at in range(0, batch.num_rows, WORDS_A_BATCH):
                part = batch.slice(at, WORDS_A_BATCH)
                logs = lattice.log_probabilities([_as_pieces(w) for w in part.column(0).to_pylist()]) / LN10
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(logs)], names=["word", "learned", "seen", "log10"])

    kept = words.where("word is not null").select("word", "learned", "seen")
    return kept.mapInArrow(solve, "word binary, learned long, seen long, log10 double")


def frequent(words: DataFrame, most: int) -> DataFrame:
    """The words counted at least as often as the least threshold that at most `most` words reach; nothing is sorted."""
    level = F.floor(4 * F.log2(F.col("learned") + F.col("seen"))).cast("int")
    least, held = None, 0
    for row in sorted(words.groupBy(level.alias("level")).count().collect(), reverse=True):
        held += row["count"]
        if held > most:
            break
        least = row["level"]
    return words.where(level >= least) if least is not None else words.limit(0)


def score(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    ship(docs.sparkSession)
    words = materialize(count_words(docs), "words")
    shares = fit(words, path)
    total, distinct = words.agg(F.sum("learned"), F.count_if(F.col("learned") > 0)).first()
    total = total or 0
    ends = words.where("word is null").agg(F.sum("learned")).first()[0] or 0
    scored = materialize(with_scores(words, path, shares), "word-scores")
    hot = {bytes(r["word"]): (r["learned"], r["log10"]) for r in frequent(scored, HOT).collect()}
    floor = math.log10(total + distinct + 1)
    end = (math.log10(ends + 1) - floor, math.log10(shares[_vocabulary(path).end]), int(ends > 0))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {w: (math.log10(c + 1) - floor, log10, int(c > 0)) for w, (c, log10) in hot.items()}
        schema = pa.schema(
            [("doc_id", pa.int64()), ("print", pa.int64()), ("word", pa.binary()), ("times", pa.int64()), ("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("log10", pa.float64())]
        )
        for batch in batches:
            for part in slices(batch):
                columns: list[list] = [[] for _ in schema]
                for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    found = _words(text)
                    mark = xxhash.xxh3_64_intdigest(text or "") - (1 << 63)
                    base, log10, count = end
                    rare = []
                    for w, n in Counter(found).items():
                        entry = known.get(w)
                        if entry is None:
                            rare.append((w, n))
                        else:
                            base += n * entry[0]
                            log10 += n * entry[1]
                            count += n * entry[2]
                    for column, value in zip(columns, (key, mark, None, None, len(found) + 1, count, base, log10)):
                        column.append(value)
                    if rare:
                        m = len(rare)
                        some, times = zip(*rare)
                        for column, values in zip(columns, ([key] * m, [mark] * m, some, times, *([[None] * m] * 4))):
                            column += values
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = materialize(
        docs.select("doc_id", "text").mapInArrow(
            sums, "doc_id long, print long, word binary, times long, tokens long, known long, base double, log10 double"
        ),
        "document-words",
    )
    rare = (
        rows.where("word is not null")
        .select("doc_id", "print", "word", "times")
        .join(scored.select("word", "learned", F.col("log10").alias("_log10")), "word")
        .select(
            "doc_id",
            "print",
            F.lit(0).cast("long").alias("copies"),
            F.lit(0).cast("long").alias("tokens"),
            F.when(F.col("learned") > 0, F.col("times")).otherwise(0).alias("known"),
            (F.col("times") * (F.log10(F.col("learned") + 1.0) - floor)).alias("base"),
            (F.col("times") * F.col("_log10")).alias("log10"),
        )
    )
    whole = rows.where("word is null").select("doc_id", "print", F.lit(1).cast("long").alias("copies"), "tokens", "known", "base", "log10")
    # rows that repeat a document add up alike, so each copy's share is the same
    by_text = whole.union(rare).groupBy("doc_id", "print").agg(*(F.sum(c).alias(c) for c in ("copies", "tokens", "known", "base", "log10")))
    each = by_text.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    share = lambda c: F.expr(f"{c} div copies")
    return each.select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held_out"),
        share("tokens").alias("n_tokens"),
        share("known").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        (F.col("log10") / F.col("copies")).alias("score"),
    )
