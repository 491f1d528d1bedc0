"""Byte-pair encoding by depth-first traversal of a trie of distinct words.

Every prefix of a word has one encoding, and that encoding is known from its last token
and the encoding of what precedes it. Distinct words in sorted order are their trie in
depth-first order: the path to the current word holds one last token for each prefix, so
prefixes that words share are encoded once. A prefix's last token is the one vocabulary
suffix that is compatible with the last token before it, that is, the pair of tokens
encodes to itself. The final symbol of a word is a symbol of its own (it carries the end
of the word), so a word ends in a leaf.

The work is a plain map over documents: no shuffle, the tables of the tokenizer are read
once a task, words seen before in the task are looked up, and the new words of SLICE_ROWS
documents (or of SLICE_BYTES of text) share a trie. Case, normal form and classes of
characters beyond the Latin script are those of the tokenizer's own normaliser.

Defined cases: a null text counts as empty; an empty text has no ids and decodes to the
empty string; a very long text or word is encoded whole; equal words have equal ids;
repeated rows are encoded each for itself; an empty table gives an empty result; other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from functools import cache

import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .arrowmap import map_slices

TOKENIZER = "word_bpe_49k.json"
#: Words whose encodings a task keeps; beyond, it starts anew. Documents whose new words share a trie.
KEPT_WORDS, SLICE_ROWS = 400_000, 2048
#: Characters for which this Python and the tokenizers library are sure to agree on case, normal form and class.
LATIN = re.compile(r"[^\x00-\u02ff]")


def _byte_symbols() -> list[str]:
    """Symbol of each byte in the vocabulary: visible Latin-1 characters stand for themselves, the others for 256 onwards in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(visible) else chr(next(rest)) for b in range(256)]


class TrieEncoder:
    """Encodings of words by one tokenizer file of byte-level pairs with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.symbol = _byte_symbols()
        # symbols of a word: byte b is chr(b), a final byte b is chr(256 + b)
        to_inner = {s: chr(b) for b, s in enumerate(self.symbol)}
        inner: dict[str, int] = {}
        for token, i in vocab.items():
            ends = bool(self.suffix) and token.endswith(self.suffix) and len(token) > len(self.suffix)
            body = token[: -len(self.suffix)] if ends else token
            if all(c in to_inner for c in body):
                chars = [to_inner[c] for c in body]
                if ends:
                    chars[-1] = chr(256 + ord(chars[-1]))
                inner["".join(chars)] = i
        self.inner = inner
        self.longest = max(map(len, inner))
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            made = vocab[left + right]
            self.merge[vocab[left], vocab[right]] = (rank, made)
            self.parts.setdefault(made, (rank, vocab[left], vocab[right]))
        self.known: dict[tuple[int, int], bool] = {}
        self.cache: dict[str, tuple[bytes, str]] = {}
        # The word pattern of the tokenizer file and its special tokens.
        self.word = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
        # the tokenizer file's own normaliser and splitter, for texts beyond the Latin script
        own = Tokenizer.from_file(path)
        self.normalize, self.cut = own.normalizer.normalize_str, own.pre_tokenizer.pre_tokenize_str
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens a, b stay apart: no merge across their border comes before the merges that made them.

        Backwards from the end: undo the later of the two last merges, as long as what
        then touches the border could not have merged earlier.
        """
        pair = (a, b)
        known = self.known.get(pair)
        if known is None:
            known = self.known[pair] = self._apart(a, b)
        return known

    def _apart(self, a: int, b: int) -> bool:
        none = (-1, 0, 0)
        before = len(self.merge)
        # of equal merges the left one comes first: a's own merge precedes one of equal rank across the border,
        # which in turn precedes b's own
        while True:
            across = self.merge.get((a, b))
            if across is not None and across[0] < before:
                return False
            ra, _, right = self.parts.get(a, none)
            rb, left, _ = self.parts.get(b, none)
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                before, a = ra, right
            else:
                before, b = rb + 1, left

    def encode_words(self, words: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of distinct words; words are strings of inner symbols."""
        out: dict[str, tuple[int, ...]] = {}
        inner, longest, known, apart = self.inner, self.longest, self.known, self.compatible
        last: list[int] = []  # of each prefix of the current path
        back: list[int] = []  # length of the prefix before that last token
        path = ""
        for word in sorted(words):
            shared = 0
            most = min(len(path), len(word))
            while shared < most and path[shared] == word[shared]:
                shared += 1
            del last[shared:], back[shared:]
            for end in range(shared + 1, len(word) + 1):
                for start in range(max(0, end - longest), end):
                    token = inner.get(word[start:end])
                    if token is None:
                        continue
                    if start:
                        pair = (last[start - 1], token)
                        fits = known.get(pair)
                        if not (apart(*pair) if fits is None else fits):
                            continue
                    last.append(token)
                    back.append(start)
                    break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
            ids: list[int] = []
            end = len(word)
            while end:
                ids.append(last[end - 1])
                end = back[end - 1]
            out[word] = tuple(reversed(ids))
            path = word
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self.cache) + len(words) > KEPT_WORDS:
            self.cache.clear()
        as_inner: dict[str, str] = {}
        for w in words:
            raw = w.encode().decode("latin-1")
            as_inner[w] = raw[:-1] + chr(256 + ord(raw[-1])) if self.suffix else raw
        coded = self.encode_words(list(as_inner.values()))
        for w, key in as_inner.items():
            ids = coded[key]
            self.cache[w] = (struct.pack(f"<{len(ids)}I", *ids), " ".join(self.text_of[i] for i in ids))

    def _words(self, text: str) -> list[str]:
        if text.isascii() or not LATIN.search(text):
            return self.word.findall(text.lower())
        text = self.normalize(text)
        return [text[a:b] for _, (a, b) in self.cut(text)]

    def split(self, text: str) -> list[str]:
        """Words in order; a special token is an element of its own, marked by a leading NUL."""
        parts = self.specials.split(text) if self.specials and any(s in text for s in self.special) else [text]
        out: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append("\0" + part)
            elif part:
                out += self._words(part)
        return out

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        split = [self.split(t or "") for t in texts]
        fresh = {w for words in split for w in set(words) if w not in self.cache}
        marked = {w for w in fresh if w[0] == "\0" and w[1:] in self.special}
        if fresh:
            if len(self.cache) + len(fresh) > KEPT_WORDS:
                self.cache.clear()
                fresh = {w for words in split for w in words}
                marked = {w for w in fresh if w[0] == "\0" and w[1:] in self.special}
            self._learn(fresh - marked)
            for w in marked:
                self.cache[w] = (struct.pack("<I", self.special[w[1:]]), w[1:])
        got = self.cache
        out = []
        for words in split:
            pairs = [got[w] for w in words]
            out.append((b"".join([p[0] for p in pairs]), " ".join([p[1] for p in pairs])))
        return out


@cache
def _encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def bpe_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: number of ids, digests of ids and of the decoded text."""
    path = path or tokenizer_path(TOKENIZER)

    def make():
        encoder = _encoder(path)

        def work(ids, texts):
            found = encoder.encode(texts)
            return {
                "doc_id": ids,
                "n_tokens": [len(f[0]) // 4 for f in found],
                "ids_sha256": [hashlib.sha256(f[0]).hexdigest() for f in found],
                "decoded_sha256": [hashlib.sha256(f[1].encode()).hexdigest() for f in found],
            }

        return work

    return map_slices(docs.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", SLICE_ROWS)
