"""SentencePiece encoding and decoding that keeps the place of every piece in the source.

Normalisation goes along the UTF-8 bytes of a text and takes, at each place, the longest
prefix that the model's compiled character map holds (a double-array trie with its
replacement strings), else one character; beside every character of the outcome stands
the source byte at which it began. The normalised text is cut where no piece of the
vocabulary can reach across (before white-space marks, at characters that stand in no
longer piece), each cut is merged by the scores of the pieces, best first, leftmost of
equals, and every piece is projected along the alignment to a span of source bytes.
Characters outside the vocabulary fall back to their bytes, of which the last holds the
character's span and the others an empty one at its start.

The work is a plain map over documents: no shuffle, the model is read once a task, and
cuts seen before in the task are looked up.

Defined cases: a null text counts as empty; an empty text has no ids but begin and end and
decodes to the empty string; a very long text is encoded whole, in time n log n for a cut
of n characters; of equal scores the leftmost merges first; repeated rows are encoded each
for itself; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from .arrowmap import map_slices
from .bpe import tokenizer_path

MODEL = "piece_bpe_32k.model"
#: Encoded cuts that a worker keeps: those it met last, KEPT_CUTS at least and twice as many at most, of KEPT_LENGTH characters at most.
KEPT_CUTS, KEPT_LENGTH = 400_000, 128
#: A cut of so many characters is merged by scanning its pairs, a longer one by a heap.
SHORT = 48
# Fixed values of the model format: the mark of a space, kinds of pieces.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = range(1, 7)


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        number, wire = divmod(varint(), 8)
        if wire == 0:
            yield number, varint()
        else:
            size = varint() if wire == 2 else 8 if wire == 1 else 4
            yield number, raw[at : at + size]
            at += size


class CharacterMap:
    """The compiled map: longest replacement for the bytes at a place, by a walk along the double array."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4) if blob else ()
        self.strings = blob[4 + size :]

    def __bool__(self) -> bool:
        return bool(self.units)

    def longest(self, raw: bytes, at: int) -> tuple[int, str] | None:
        """(number of bytes taken, replacement), None if the map holds no prefix of raw[at:]."""
        units, found = self.units, None
        node = self._offset(units[0])
        for end in range(at, len(raw)):
            node ^= raw[end]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[end]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (end + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        begin = found[1]
        return found[0], self.strings[begin : self.strings.index(b"\0", begin)].decode()

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)


class Model:
    """Encodings and decodings of one model file with merged pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            fields = list(_fields(f.read()))
        pieces = [dict(_fields(v)) for n, v in fields if n == 1]
        trainer, norm = (dict(_fields(next((v for n, v in fields if n == k), b""))) for k in (2, 3))
        if trainer.get(3, 1) != 2:
            raise ValueError("the model's pieces are not merged pairs")
        self.pieces = [p.get(1, b"").decode() for p in pieces]
        self.kind = [p.get(3, NORMAL) for p in pieces]
        score = [struct.unpack("<f", p.get(2, bytes(4)))[0] for p in pieces]
        self.marks = set(i for i, k in enumerate(self.kind) if k == CONTROL)
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kind[i] in (NORMAL, USER_DEFINED, UNUSED)}
        self.score = {p: score[i] for p, i in self.ids.items()}
        self.unknown = self.kind.index(UNKNOWN)
        self.begin, self.end = (self.pieces.index(x) for x in (trainer.get(46, b"<s>").decode(), trainer.get(47, b"</s>").decode()))
        self.unknown_text = trainer.get(44, " ⁇ ".encode()).decode()
        self.bytes_ = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(self.kind) if k == BYTE} if trainer.get(35, 0) else {}
        self.byte_of = {i: b for b, i in self.bytes_.items()}
        self.map = CharacterMap(norm.get(2, b""))
        self.prefix, self.squeeze, self.escape = norm.get(3, 1), norm.get(4, 1), norm.get(5, 1)
        if trainer.get(24, 0):
            raise ValueError("white space as a suffix is not supported")
        own = sorted((p for i, p in enumerate(self.pieces) if self.kind[i] == USER_DEFINED), key=len, reverse=True)
        self.frozen = re.compile("|".join(map(re.escape, own))) if own else None
        # equal scores have equal ranks
        ranks = {v: r for r, v in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = {p: ranks[v] for p, v in self.score.items()}
        self.scanned = not self.frozen and UNUSED not in self.kind
        self.packed = {p: struct.pack("<I", i) for p, i in self.ids.items()}
        self.width = {p: struct.pack("<I", len(p)) for p in self.ids}
        self.text_of = {i: "" if i in self.marks else p.replace(SPACE, " ") for i, p in enumerate(self.pieces) if i not in self.byte_of} | {self.unknown: self.unknown_text}
        self.cuts = self._cuts()
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}

    def _cuts(self) -> re.Pattern:
        """Cuts between which no piece reaches.

        ASCII characters that only stand alone are cuts of their own; others begin at spaces, and behind
        letters at ASCII signs that no piece has behind a letter or digit.
        """
        longer = [p for p in self.ids if len(p) > 1]
        if self.frozen or not self.escape or any(SPACE in p.lstrip(SPACE) for p in longer):
            return re.compile("(?s).+")
        used, pairs = set("".join(longer)), {p[i : i + 2] for p in longer for i in range(len(p) - 1)}
        alone = [c for c in map(chr, range(128)) if c not in used]
        after = {y for x, y in pairs if x.isalnum()}
        signs = [c for c in map(chr, range(128)) if c in used and not c.isalnum() and c not in after]
        a, f = (re.escape("".join(x)) for x in (alone, signs))
        runs = (f"{SPACE}*[^\\W_{a}]++(?=[{f}])|" if f else "") + f"{SPACE}*[^{SPACE}{a}]+|{SPACE}+"
        return re.compile(f"[{a}]|{runs}" if a else runs)

    def normalize(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text and the source byte of each of its characters, with one more for the end."""
        raw = text.encode()
        size, at = len(raw), 0
        if raw and not self.map and not self.squeeze and not self.frozen:
            # no prefix to look for: the places are those of all characters, found at once
            starts = np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)
            mark = SPACE if self.escape else " "
            return mark * bool(self.prefix) + text.replace(" ", mark), np.concatenate(([0] * bool(self.prefix), starts, [size])).astype(np.int64)

        def step(at: int) -> tuple[str, int]:
            if self.frozen and (m := self.frozen.match(raw[at : at + 4096].decode(errors="ignore"))):
                return m[0], len(m[0].encode())
            if self.map and (found := self.map.longest(raw, at)):
                return found[1], found[0]
            lead = raw[at]
            n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return raw[at : at + n].decode(), n

        if self.squeeze:
            while at < size:
                made, n = step(at)
                if made != " ":
                    break
                at += n
        if at >= size:
            return "", np.array([size])
        mark = SPACE if self.escape else " "
        out, places = [], array("q")
        if self.prefix:
            out.append(mark)
            places.append(at)
        after_space = bool(self.squeeze)
        while at < size:
            made, n = step(at)
            if after_space and self.squeeze:
                made = made.lstrip(" ")
            for c in made:
                out.append(mark if c == " " else c)
                places.append(at)
            if made:
                after_space = made[-1] == " "
            at += n
        if self.squeeze:
            while out and out[-1] == mark:
                out.pop()
                size = places.pop()
        places.append(size)
        return "".join(out), np.array(places)

    def _merge(self, text: str) -> list[str]:
        """Pieces of one cut: adjacent symbols merge, best score first, the leftmost of equals."""
        if self.frozen:
            symbols, fixed, at = [], [], 0
            for m in self.frozen.finditer(text):
                symbols += [*text[at : m.start()], m[0]]
                fixed += [False] * (m.start() - at) + [True]
                at = m.end()
            symbols += text[at:]
            fixed += [False] * (len(symbols) - len(fixed))
        else:
            symbols, fixed = list(text), None
        count, score = len(symbols), self.score
        if count == 1:
            return symbols
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        halves: dict[str, tuple[str, str]] = {}
        heap = []

        def propose(a: int, b: int) -> None:
            if fixed and (fixed[a] or fixed[b]):
                return
            made = symbols[a] + symbols[b]
            if (s := score.get(made)) is not None:
                heapq.heappush(heap, (-s, a, b, made))
                if self.kind[self.ids[made]] == UNUSED:
                    halves[made] = (symbols[a], symbols[b])

        for i in range(count - 1):
            propose(i, i + 1)
        while heap:
            _, a, b, made = heapq.heappop(heap)
            # stale if a side is gone or has grown since
            if after[a] != b or not symbols[a] or symbols[a] + symbols[b] != made:
                continue
            symbols[a], symbols[b] = made, ""
            following = after[a] = after[b]
            if following < count:
                before[following] = a
                propose(a, following)
            if before[a] >= 0:
                propose(before[a], a)
        out: list[str] = []
        for s in symbols:
            if s:
                todo = [s]
                while todo:
                    piece = todo.pop()
                    if piece in halves and self.kind[self.ids[piece]] == UNUSED:
                        todo += reversed(halves[piece])
                    else:
                        out.append(piece)
        return out

    def _scan(self, cut: str) -> list[str]:
        """As _merge, for a short cut."""
        symbols, rank, none = list(cut), self.rank.get, len(self.rank)
        ranks = [rank(a + b, none) for a, b in zip(symbols, symbols[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            symbols[i] += symbols.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(symbols[i] + symbols[i + 1], none)
            if i:
                ranks[i - 1] = rank(symbols[i - 1] + symbols[i], none)
        return symbols

    def _split(self, cut: str) -> list[str]:
        return self._scan(cut) if self.scanned and len(cut) <= SHORT else self._merge(cut)

    def _encode_cut(self, cut: str) -> tuple[bytes, bytes]:
        """ids, and how many characters each takes, both as little-endian unsigned 32-bit integers."""
        pieces = self._split(cut)
        try:
            return b"".join([self.packed[p] for p in pieces]), b"".join([self.width[p] for p in pieces])
        except KeyError:
            placed = list(self._placed(pieces))
            return struct.pack(f"<{len(placed)}I", *(i for i, _, _ in placed)), struct.pack(f"<{len(placed)}I", *(b - a for _, a, b in placed))

    def _placed(self, pieces: list[str]) -> Iterator[tuple[int, int, int]]:
        """(id, begin, end) in characters; of the bytes of a character the last has its place."""
        at = 0
        for piece in pieces:
            i, end = self.ids.get(piece, self.unknown), at + len(piece)
            if i == self.unknown and self.bytes_:
                *raw, last = piece.encode()
                for b in raw:
                    yield self.bytes_[b], at, at
                i = self.bytes_[last]
            yield i, at, end
            at = end

    def _surface(self, ids: list[int]) -> str:
        text_of = self.text_of
        try:
            return "".join([text_of[i] for i in ids])
        except KeyError:
            pass  # some are bytes
        out, run = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_lenient(run))
                run.clear()
            out.append(text_of[i])
        out.append(_lenient(run))
        return "".join(out)

    def _encoded(self, normal: str) -> list[tuple[bytes, bytes]]:
        cuts, known = self.cuts.findall(normal), self.known
        try:
            return [known[c] for c in cuts]
        except KeyError:
            pass
        if len(known) > KEPT_CUTS:
            self.older, self.known = known, {}
            known = self.known
        older, long = self.older, {}
        for c in cuts:
            if c not in known and c not in long:
                (known if len(c) <= KEPT_LENGTH else long)[c] = older.get(c) or self._encode_cut(c)
        return [known[c] if c in known else long[c] for c in cuts]

    def aligned(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids without begin and end, first source byte and source byte after the last of each; bytes that normalisation drops lie between spans or within them."""
        normal, places = self.normalize(text or "")
        found = self._encoded(normal)
        ids, widths = (np.frombuffer(b"".join([f[k] for f in found]), "<u4") for k in (0, 1))
        stops = np.cumsum(widths, dtype=np.int64)
        starts = stops - widths
        if not self.bytes_ and len(ids):
            # unknown characters in a row are one piece
            more = np.append(False, (ids[1:] == self.unknown) & (ids[:-1] == self.unknown))
            kept = np.flatnonzero(~more)
            ids, starts, stops = ids[kept], starts[kept], stops[np.append(kept[1:], len(more)) - 1]
        return ids, places[starts], places[stops]

    def marked(self, ids: np.ndarray) -> bytes:
        """ids with begin and end as little-endian unsigned 32-bit integers."""
        return struct.pack("<I", self.begin) + ids.astype("<u4").tobytes() + struct.pack("<I", self.end)

    def encode(self, text: str | None) -> tuple[bytes, str, int]:
        """(ids with begin and end as little-endian unsigned 32-bit integers, decoded text, source bytes that the spans hold)."""
        ids, begins, ends = self.aligned(text)
        return self.marked(ids), self.decode(ids.tolist()), int((ends - begins).sum())

    def _dropped(self, ids: list[int]) -> int:
        """Spaces that decoding leaves out at the front: the mark of the first piece, with squeezed spaces those of further pieces until one shows."""
        dropped = 0
        for i in ids if self.prefix or self.squeeze else ():
            if i in self.marks:
                continue
            if i in self.byte_of or i == self.unknown or not self.pieces[i].startswith(SPACE):
                break
            dropped += 1
            if not self.squeeze or len(self.pieces[i]) > 1:
                break
        return dropped

    def spans(self, text: str | None) -> tuple[list[int], list[int], list[int]]:
        """As aligned, in lists."""
        return tuple(found.tolist() for found in self.aligned(text))

    def decode(self, ids: list[int]) -> str:
        return self._surface(ids)[self._dropped(ids) :]


def _lenient(run: bytes | bytearray) -> str:
    """Text of a run of byte pieces; a byte that belongs to no character becomes U+FFFD by itself."""
    try:
        return run.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[at : at + n]).decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


@cache
def model(path: str) -> Model:
    return Model(path)


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, begins, ends): ids without begin and end, and the source bytes begins[i]..ends[i]-1 of the i-th."""
    path = path or tokenizer_path(MODEL)

    def make():
        spans = model(path).spans

        def work(keys, texts):
            found = [spans(t) for t in texts]
            return {key: keys} | {name: [f[i] for f in found] for i, name in enumerate(("ids", "begins", "ends"))}

        return work

    return map_slices(docs.select(key, text), make, f"{key} long, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text): the text that ids decode to; null ids count as none."""
    path = path or tokenizer_path(MODEL)

    def make():
        back = model(path).decode
        return lambda keys, rows: {key: keys, "text": [back(r or []) for r in rows]}

    return map_slices(encoded.select(key, ids), make, f"{key} long, text string")


def piece_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: number of ids, digests of ids and of the text that they decode to, source bytes that the pieces' spans hold.

    Each text takes every step of encode() and decode(); only digests of what these give leave the task.
    """
    path = path or tokenizer_path(MODEL)

    def make():
        one = model(path).encode

        def work(ids, texts):
            found = [one(t) for t in texts]
            return {
                "doc_id": ids,
                "n_tokens": [len(f[0]) // 4 for f in found],
                "ids_sha256": [hashlib.sha256(f[0]).hexdigest() for f in found],
                "decoded_sha256": [hashlib.sha256(f[1].encode()).hexdigest() for f in found],
                "span_bytes": [f[2] for f in found],
            }

        return work

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, span_bytes long")
