"""Letters-and-digits tokens of batches of texts, as numpy arrays of 64-bit hashes.

Tokens are runs of letters and digits (every byte of a character beyond ASCII counts as a
letter); a point or comma between digits belongs to them. Capitals of ASCII, Latin-1, Greek and
Cyrillic count as small letters. A hash is a polynomial over the bytes, mixed at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from starloom.llm.shingles import _BASE, _TABLE, LOWER, _power, mixed

_ALPHA = np.zeros(256, bool)
_ALPHA[48:58] = _ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;\n"]] = True

WORD, NUMBER, INSIDE, FIRST = 0, 1, 2, 3


@dataclass
class Tokens:
    """`kinds`: WORD; NUMBER with a digit; capitalised INSIDE or as the FIRST of a sentence.

    `ended`: whether a sentence ends after the last token.
    """

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    kinds: np.ndarray
    ended: bool
    total: np.ndarray  # running polynomial of the bytes

    def prefixes(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens are longer than `size` bytes, and the hashes of their first bytes."""
        at = np.flatnonzero(self.ends - self.starts > size)
        s = self.starts[at]
        h = (self.total[s + size] - self.total[s]) * _power(pow(_BASE, -1, 1 << 64), len(self.total))[s]
        return at, mixed(mixed(h) + np.uint64(size))


def lowered(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small letters for the capitals of ASCII, Latin-1, Greek and Cyrillic, and where they were."""
    out = LOWER[raw]
    capital = out != raw
    lead, at = raw[:-1], raw[1:]

    def fold(first, low, high, lead_to, shift):
        hit = np.flatnonzero((lead == first) & (at >= low) & (at <= high) & (at != 0x97 if first == 0xC3 else True))
        out[hit], capital[hit] = lead_to, True
        out[hit + 1] = raw[hit + 1] + np.uint8(shift % 256)

    fold(0xC3, 0x80, 0x9E, 0xC3, 0x20)
    if (raw >= 0xCE).any():
        fold(0xCE, 0x91, 0x9F, 0xCE, 0x20)
        fold(0xCE, 0xA0, 0xA9, 0xCF, -0x20)
        fold(0xD0, 0x90, 0x9F, 0xD0, 0x20)
        fold(0xD0, 0xA0, 0xAF, 0xD1, -0x20)
    return out, capital


def tokens(raw: np.ndarray, begins: np.ndarray, fresh: bool = True) -> Tokens:
    """Tokens of these bytes; a text begins at each of `begins`. `fresh`: the first is at the
    begin of a sentence."""
    none = np.zeros(0, np.int64)
    if not len(raw):
        return Tokens(none, none, none.astype(np.uint64), none, fresh, np.zeros(1, np.uint64))
    small, capital = lowered(raw)
    own = _ALPHA[raw]
    digit = _DIGIT[raw]
    inner = (raw == 46) | (raw == 44)
    inner[1:] &= digit[:-1]
    inner[:-1] &= digit[1:]
    inner[[0, -1]] = False
    own |= inner
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = ~own[:-1]
    edge[begins[begins < len(raw)]] = True
    starts = np.flatnonzero(edge[:-1] & own)
    edge[:-1] = ~own
    edge[begins[begins < len(raw)]] = True
    ends = np.flatnonzero(edge[1:] & own) + 1

    def count(flags, a, b):
        total = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(flags, out=total[1:])
        return total[b] - total[a]

    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[small] * _power(_BASE, len(raw)), out=total[1:])
    hashes = (total[ends] - total[starts]) * _power(pow(_BASE, -1, 1 << 64), len(raw))[starts]
    hashes = mixed(hashes + (ends - starts).astype(np.uint64))
    # one capital in front; a word all in capitals is no name
    capital = capital[starts] & (count(capital, starts, ends) == 1) & (ends - starts > 1)
    stop = _STOP[raw]
    after = np.r_[0, ends[:-1]] if len(ends) else none
    new = count(stop, after, starts) > 0
    new |= np.searchsorted(begins, starts, "right") != np.searchsorted(begins, after, "right") if len(
        starts) else False
    if len(starts):
        new[0] = fresh or bool(stop[:starts[0]].any())
        # the first token of a text begins a sentence
        text = np.searchsorted(begins, starts, "right")
        new[1:] |= text[1:] != text[:-1]
    kinds = np.where(
        count(digit, starts, ends) > 0, NUMBER, np.where(capital, np.where(new, FIRST, INSIDE), WORD))
    last = ends[-1] if len(ends) else 0
    ended = bool(stop[last:].any()) or (fresh and not len(ends))
    return Tokens(starts, ends, hashes, kinds, ended, total)
