"""Words, their hashes and their word shingles, for many texts at once, on UTF-8 bytes.

A word is a longest run of bytes of a class. Both classes used here hold every
byte from 0x80 up, so a character outside ASCII is never cut.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = np.arange(256)
#: Words between white space: every byte but 0x20 and 0x09 to 0x0D.
NOT_SPACE = (_BYTES != 0x20) & ((_BYTES < 0x09) | (_BYTES > 0x0D))
#: Words of digits, letters and everything outside ASCII.
WORD_CHARS = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
)
_LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}
#: Powers that a worker keeps; longer sequences have theirs made anew.
_KEPT_POWERS = 1 << 20


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if len(known) <= _KEPT_POWERS:
            _powers[str(base)] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of a chunk in order: byte range, first word of each text, hash."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray, hashes: bool = True) -> Words:
    """The words of the texts between ``offsets``, A-Z lower-cased."""
    data = _LOWER[data]
    inside = in_word[data]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edge] = inside[edge]
    stops[:-1] &= ~inside[1:]
    stops[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(start, offsets)
    if not hashes:
        return Words(start, end, first, np.empty(0, np.uint64))
    return Words(start, end, first, hashes_of(_VALUES[data], start, end))


def hashes_of(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the stretches from ``start`` to ``end`` of a sequence of random values."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(_BASE, len(values)), out=total[1:])
    inverse = _power(pow(_BASE, -1, 2**64), len(values) + 1)
    return mix((total[end] - total[start]) * inverse[start])


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where each distinct hash stands first, which of them each element is), in the order they appear."""
    import pandas as pd

    which, values = pd.factorize(hashes)
    first = np.empty(len(values), np.int64)
    first[which[::-1]] = np.arange(len(hashes) - 1, -1, -1)
    return first, which


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``n`` words of each text: (bounds by text, hashes, sorted in each).

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    h, size = w.hash, len(w.hash)
    step = np.uint64(0xD6E8FEB86659FD93)
    total = np.zeros(max(size - n + 1, 0), np.uint64)
    factor = np.uint64(1)
    with np.errstate(over="ignore"):
        for j in range(n):
            total += h[j : size - n + 1 + j] * factor if size >= n else 0
            factor *= step
        total = mix(total + np.uint64(n))
        sets = []
        for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
            if b - a >= n:
                sets.append(np.unique(total[a : b - n + 1]))
            elif b > a:
                factor, whole = np.uint64(1), np.uint64(b - a)
                for x in h[a:b]:
                    whole += x * factor
                    factor *= step
                sets.append(mix(np.array([whole], np.uint64)))
            else:
                sets.append(total[:0])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return bounds, np.concatenate(sets) if sets else total[:0]
