"""Byte-pair encoding and decoding of whole texts with a public word vocabulary.

A word's symbols and the ranks of their neighbouring pairs are kept in a segment tree of minima.
Its root names the lowest rank, the walk to the first leaf that has it names the leftmost such
pair; the merge changes three leaves, each in logarithmic time, until no pair has a rank. A run of
a million letters costs a million times twenty steps, not a million squared. Short words that are
new to a task have their trees side by side in one array and are merged in step.

Read from the vocabulary file (the JSON format of the tokenizers library): byte-level symbols with
a mark at a word's end, Unicode normalisation NFC, blanks collapsed, letters in lower case one by
one, words by the file's own pattern. Tokens that the file adds are found in the raw text, before
anything else. A file of another kind raises ValueError. Decoding joins the tokens' strings with
blanks, end marks included, and leaves out ids that the file does not know.

The file is read by the driver and sent to the tasks (its size does not follow the data). A task
remembers the ids of up to CACHE words, and of as many runs between blanks; that changes no result.

Defined cases: a null text is empty and has no ids; ids of null decode to the empty text. Each row
is worked off on its own, so repeated rows and ties need nothing. An empty table gives an empty
result. Extra columns are kept; one with the name of the result is replaced by it. Letters and
numbers are those of the installed `regex` module, whose Unicode version may know some code points
that the library's does not know yet.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession, functions as F

NONE = 1 << 62
# Words and runs that a task remembers; characters whose new words it encodes together; how many
# of them side by side, and up to how many bytes each. A longer word has the tree for itself.
CACHE, BLOCK, BESIDE, LONGEST = 1 << 19, 1 << 20, 1 << 13, 62

# The steps before the merges that are understood.
NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class PairTree:
    """Minima over the ranks of neighbouring pairs, one leaf for each place of a left symbol."""

    def __init__(self, ranks: list[int]):
        self.size = size = 1 << max(len(ranks) - 1, 0).bit_length()
        level = ranks + [NONE] * (size - len(ranks))
        self.least = level
        while len(level) > 1:
            level = list(map(min, level[::2], level[1::2]))
            self.least = level + self.least
        self.least.insert(0, NONE)

    def first(self) -> tuple[int, int]:
        """(lowest rank, leftmost place that has it); the rank is NONE if no pair is left."""
        least, size, k = self.least, self.size, 1
        rank = least[1]
        while k < size:
            k <<= 1
            if least[k] != rank:
                k += 1
        return rank, k - size

    def put(self, place: int, rank: int) -> None:
        least, k = self.least, place + self.size
        least[k] = rank
        while k > 1:
            beside = least[k ^ 1]
            k >>= 1
            if beside < rank:
                rank = beside
            if least[k] == rank:
                return
            least[k] = rank


class Encoder:
    """The content of a vocabulary file, with the ids of the words met last."""

    def __init__(self, content: bytes):
        spec = json.loads(content)
        model, before = spec["model"], spec["pre_tokenizer"]
        _understood(spec)
        vocab, self.end = model["vocab"], model["end_of_word_suffix"]
        self.tokens = {number: token for token, number in vocab.items()}
        self.ranks, merged = {}, []
        for rank, (left, right) in enumerate(model["merges"]):
            self.ranks.setdefault((vocab[left], vocab[right]), rank)
            merged.append(vocab[left + right])
        self.merged = np.array(merged, np.int64)
        pairs = sorted((left << 32 | right, rank) for (left, right), rank in self.ranks.items())
        self.pair_keys, self.pair_ranks = (np.array(c, np.int64) for c in zip(*pairs))
        symbols = _byte_symbols()
        self.inner = [vocab[c] for c in symbols]
        self.last = [vocab[c + self.end] for c in symbols]
        self.word = regex.compile(before["pretokenizers"][0]["pattern"]["Regex"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({number: token for token, number in self.added.items()})
        longest = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        # Added tokens stand among the runs of a text as numbers, so that no text is one.
        self.marks = {number: _packed([number]) for number in self.added.values()}
        self.known: dict[str | int, bytes] = dict(self.marks)
        self.words: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols of a word after all merges, always the leftmost of lowest rank first."""
        n, rank_of = len(symbols), self.ranks.get
        if n < 2:
            return symbols
        tree = PairTree([rank_of(pair, NONE) for pair in zip(symbols, symbols[1:])])
        after, before = list(range(1, n + 1)), list(range(-1, n))
        while True:
            rank, at = tree.first()
            if rank == NONE:
                break
            gone = after[at]
            right, left = after[gone], before[at]
            symbols[at], symbols[gone] = int(self.merged[rank]), -1
            after[at], before[right] = right, at
            if right < n:
                tree.put(gone, NONE)
                tree.put(at, rank_of((symbols[at], symbols[right]), NONE))
            else:
                tree.put(at, NONE)
            if left >= 0:
                tree.put(left, rank_of((symbols[left], symbols[at]), NONE))
        return [s for s in symbols if s >= 0]

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of symbols; NONE for a pair without one and beside a word's end (-1)."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def merge_beside(self, words: list[list[int]]) -> list[list[int]]:
        """`merge` for many words of similar length at once, each with a tree of its own.

        A word stands between two ends (-1), so that a pair with an end is like any other pair
        without a rank. The arrays are flat: node or place k of word w is at k * n + w.
        """
        n, wide = len(words), max(map(len, words)) + 2
        size = 1 << (wide - 1).bit_length()
        symbols = np.full((wide, n), -1, np.int64)
        for k, word in enumerate(words):
            symbols[1:len(word) + 1, k] = word
        least = np.full((2 * size, n), NONE)
        least[size:size + wide - 1] = self.pair_rank(symbols[:-1], symbols[1:])
        half = size
        while half > 1:
            least[half // 2:half] = np.minimum(least[half:2 * half:2], least[half + 1:2 * half:2])
            half //= 2
        after, before = (np.repeat(np.arange(wide)[:, None] + d, n, 1) for d in (1, -1))
        symbols, least, after, before = (x.reshape(-1) for x in (symbols, least, after, before))

        def put(place: np.ndarray, rank: np.ndarray | int) -> None:
            node = place + size
            least[node * n + word] = rank
            while node[0] > 1:
                low = np.minimum(least[node * n + word], least[(node ^ 1) * n + word])
                node = node >> 1
                least[node * n + word] = low

        word = np.arange(n)
        while True:
            rank = least[n + word]
            word, rank = word[rank < NONE], rank[rank < NONE]
            if not len(word):
                break
            node = np.ones(len(word), np.int64)
            while node[0] < size:
                node = 2 * node
                node += least[node * n + word] != rank
            at = node - size
            gone, left = after[at * n + word], before[at * n + word]
            right = after[gone * n + word]
            symbols[at * n + word], symbols[gone * n + word] = self.merged[rank], -1
            after[at * n + word], before[right * n + word] = right, at
            put(gone, NONE)
            put(at, self.pair_rank(symbols[at * n + word], symbols[right * n + word]))
            put(left, self.pair_rank(symbols[left * n + word], symbols[at * n + word]))
        return [[s for s in row if s >= 0] for row in symbols.reshape(wide, n).T.tolist()]

    def learn(self, words: list[str]) -> None:
        """Encode words that are not known yet; those of similar length together."""
        classes: dict[int, list[tuple[str, list[int]]]] = {}
        for word in words:
            raw = word.encode()
            symbols = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
            if len(raw) > LONGEST:
                self.words[word] = _packed(self.merge(symbols))
            else:
                classes.setdefault((len(raw) + 1).bit_length(), []).append((word, symbols))
        for some in classes.values():
            for k in range(0, len(some), BESIDE):
                part = some[k:k + BESIDE]
                for (word, _), ids in zip(part, self.merge_beside([symbols for _, symbols in part])):
                    self.words[word] = _packed(ids)

    def runs(self, text: str | None) -> list[str | int]:
        """The runs between blanks of a text, and the numbers of the added tokens in it."""
        if not text:
            return []
        if self.split is None or not any(t in text for t in self.added):
            return _chunks(text)
        pieces = self.split.split(text)
        return [c for k, p in enumerate(pieces) for c in ([self.added[p]] if k % 2 else _chunks(p))]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of texts, four bytes each, lowest byte first."""
        if len(self.known) > CACHE:
            self.known = dict(self.marks)
        if len(self.words) > CACHE:
            self.words = {}
        known, words = self.known, self.words
        runs = [self.runs(t) for t in texts]
        fresh = {run: self.word.findall(run) for run in set().union(*runs).difference(known)}
        self.learn(list({w for found in fresh.values() for w in found}.difference(words)))
        for run, found in fresh.items():
            known[run] = b"".join([words[w] for w in found])
        return [b"".join([known[run] for run in text]) for text in runs]

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids if i in self.tokens])


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _understood(spec: dict) -> None:
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    steps = before.get("pretokenizers", [{}])
    fits = (
        model["type"] == "BPE" and model["end_of_word_suffix"]
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback",
                                           "ignore_merges"))
        and (spec["normalizer"] or {}).get("normalizers") == NORMALIZERS
        and len(steps) == 2 and steps[1] == BYTE_LEVEL
        and (steps[0].get("type"), steps[0].get("behavior"), steps[0].get("invert")) == ("Split", "Removed", True)
        and spec["decoder"] is None
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
    )
    if not fits:
        raise ValueError("not a vocabulary of lower-case words with end marks")


def _byte_symbols() -> list[str]:
    """A visible character for each byte: itself if it has a shape, else the next one from 256 on."""
    shaped = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shaped else next(hidden)) for b in range(256)]


def _chunks(text: str) -> list[str]:
    """The runs between blanks of the normalised text."""
    text = unicodedata.normalize("NFC", text)
    # Lower case letter by letter: only the capital sigma has a form that depends on its neighbours.
    text = text.replace("Σ", "σ").lower()
    # The four separators 1C to 1F are blanks to split() and to nothing else here.
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [c for c in regex.split(r"\s+", text) if c]
    return text.split()


def _blocks(texts: pa.Array) -> Iterator[list[str | None]]:
    """Texts of about BLOCK characters together; a longer one alone."""
    block, size = [], 0
    for text in texts:
        text = text.as_py()
        if block and size + len(text or "") > BLOCK:
            yield block
            block, size = [], 0
        block.append(text)
        size += len(text or "")
    if block:
        yield block


@lru_cache(maxsize=2)
def _encoder(content: bytes) -> Encoder:
    return Encoder(content)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file for the tasks; read where the driver runs."""
    with open(path, "rb") as file:
        content = file.read()
    _understood(json.loads(content))
    return spark.sparkContext.broadcast(content)


def encoded(text: Column, vocabulary: Broadcast) -> Column:
    """Ids of a text as unsigned integers of four bytes, lowest byte first."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        encoder = _encoder(vocabulary.value)
        return pa.array((ids for block in _blocks(texts) for ids in encoder.encode(block)), pa.binary())

    return encode(text)


def decoded(ids: Column, vocabulary: Broadcast) -> Column:
    """The text of such ids."""

    @F.arrow_udf("string")
    def decode(rows: pa.Array) -> pa.Array:
        encoder = _encoder(vocabulary.value)
        return pa.array((encoder.decode(np.frombuffer(r.as_py() or b"", "<u4").tolist()) for r in rows), pa.string())

    return decode(ids)


def id_list(ids: Column) -> Column:
    """Such ids as an array of integers."""

    @F.arrow_udf("array<int>")
    def listed(rows: pa.Array) -> pa.Array:
        return pa.array((np.frombuffer(r.as_py() or b"", "<i4").tolist() for r in rows), pa.list_(pa.int32()))

    return listed(ids)
