"""Words and word shingles of batches of texts, as numpy arrays of 64-bit hashes.

Words are runs of bytes other than blank and the control characters 9 to 13; A-Z count as a-z.
No byte of a longer UTF-8 character is one of these, so bytes are as good as code points. A
word's hash is a polynomial over its bytes, mixed at the end. A batch is worked off in blocks of
about BLOCK bytes, and a longer text in pieces cut between words, so memory does not follow the
length of the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 20
WIDTH = 5

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}
_TABLE = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, size: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        factors = np.full(max(size, BLOCK + 1), base, np.uint64)
        factors[0] = 1
        _powers[base] = have = np.multiply.accumulate(factors)
    return have[:size]


def _hash_words(raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of these bytes; a text begins at each of `begins`."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    blank = SEPARATOR[raw]
    edge = np.ones(len(raw) + 1, bool)
    edge[1:-1] = blank[:-1]
    edge[begins[begins < len(raw)]] = True
    starts = np.flatnonzero(edge[:-1] & ~blank)
    edge[:-1] = blank
    edge[begins[begins < len(raw)]] = True
    # A word ends where the next byte is a separator or belongs to another text.
    ends = np.flatnonzero(edge[1:] & ~blank) + 1
    inverse = pow(_BASE, -1, 1 << 64)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[LOWER[raw]] * _power(_BASE, len(raw)), out=total[1:])
    hashes = (total[ends] - total[starts]) * _power(inverse, len(raw))[starts]
    return starts, mixed(hashes + (ends - starts).astype(np.uint64))


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about BLOCK bytes, cut at separators."""
    at = 0
    while at < len(raw):
        end = at + BLOCK
        while end < len(raw):
            gaps = np.flatnonzero(SEPARATOR[raw[end:end + 4096]])
            if len(gaps):
                end += int(gaps[0])
                break
            end += 4096
        yield raw[at:end]
        at = end


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an array of strings; null is empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, raw


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, offsets, bytes) of blocks of rows of about BLOCK bytes."""
    offsets, raw = _bytes(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        base = offsets[first]
        yield first, last, offsets[first:last + 1] - base, raw[base:offsets[last]]
        first = last


def words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of each row's words, hashes) of blocks of rows."""
    for first, last, offsets, raw in blocks(texts):
        if last == first + 1 and len(raw) > BLOCK:
            hashes = np.concatenate([_hash_words(p, np.zeros(1, np.int64))[1] for p in _pieces(raw)])
            yield first, np.array([0, len(hashes)]), hashes
        else:
            starts, hashes = _hash_words(raw, offsets[:-1])
            yield first, np.searchsorted(starts, offsets), hashes


def shingle_hashes(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hashes of all runs of `width` words; of the whole sequence if it is shorter."""
    size = min(width, len(hashes))
    if not size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - size + 1, np.uint64)
    for k in range(size):
        out += hashes[k:len(hashes) - size + 1 + k] * _STEP[k]
    return mixed(out + np.uint64(size))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for each text."""
    for first, offsets, hashes in words(texts):
        for k in range(len(offsets) - 1):
            yield first + k, np.unique(shingle_hashes(hashes[offsets[k]:offsets[k + 1]], width))
