"""Words of many texts at once: byte classes, spans and 64-bit hashes, vectorised over a batch.

A word is a longest run of bytes of one class, so UTF-8 needs no decoding: every separator is ASCII.
A word's hash is a polynomial over its bytes with random coefficients, then mixed. Sets of hashes
stand for sets of words: two different words share a hash with a chance of about 2**-60.
"""

from __future__ import annotations

import numpy as np

#: Text bytes that are worked on at once; arrays of them and of their words take about sixty times that.
CHUNK = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.Generator(np.random.PCG64(20240611)).integers(1, 1 << 64, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _byte_class(separators) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in separators:
        table[low:high + 1] = False
    return table


#: ``[^\x20\x09-\x0D]+``
BLANK_SEPARATED = _byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z, so capitals count as word bytes here.
ALPHANUMERIC = _byte_class([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def lowered(table: np.ndarray) -> np.ndarray:
    """A byte table that treats A-Z as a-z."""
    out = table.copy()
    out[0x41:0x5B] = table[0x61:0x7B]
    return out


_LOWER_BYTES = lowered(_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (the one of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, name: str, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        table = np.full(max(n, CHUNK + 1), base, np.uint64)
        table[0] = 1
        have = np.multiply.accumulate(table)
        if n <= CHUNK + 1:
            _POWERS[name] = have
    return have[:n]


def spans(raw: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray):
    """Start and end byte of every word, and the index of each text's first word."""
    if len(raw) == 0:
        none = np.empty(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = word_byte[raw]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[edges] = inside[edges]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of each span; with ``lower``, A-Z count as a-z."""
    if len(starts) == 0:
        return np.empty(0, np.uint64)
    table = _LOWER_BYTES if lower else _BYTES
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(table[raw] * _powers(_MULTIPLIER, "up", len(raw)), out=total[1:])
    value = (total[ends] - total[starts]) * _powers(_INVERSE, "down", len(raw) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_PLACES = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes; a shorter sequence is one run."""
    size = min(n, len(words))
    if size == 0:
        return words
    out = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        out += words[j:len(words) - size + 1 + j] * _PLACES[j]
    return mix(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) == 0:
        return values
    ordered = np.sort(values)
    keep = np.empty(len(ordered), bool)
    keep[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=keep[1:])
    return ordered[keep]
