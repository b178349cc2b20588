"""Words and word shingles of whole texts as 64-bit hashes, computed on UTF-8 bytes."""

from __future__ import annotations

from functools import cache

import numpy as np

#: White space between words: blank and tab to carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
WIDTH = 5
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_FACTORS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64)) | np.uint64(1)


@cache
def _byte_values() -> np.ndarray:
    """A random value per byte; A to Z share those of a to z."""
    values = mix(np.arange(256, dtype=np.uint64) + np.uint64(1000))
    values[65:91] = values[97:123]
    return values


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, radix in enumerate((_RADIX, _INVERSE)):
            steps = np.full(size, radix, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and how many words each text has."""
    solid = ~SPACE[data]
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, stops, counts


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of every word with A to Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power(len(data))
    sums = np.cumsum(_byte_values()[data] * power[: len(data)], dtype=np.uint64)
    before = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    return mix((sums[stops - 1] - before) * inverse[starts] + (stops - starts).astype(np.uint64))


def shingle_hashes(hashed: np.ndarray, counts: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text in order, repeats included, and their number per text.

    A text of fewer than ``width`` words has its whole sequence as its one shingle; a
    text without words has none.
    """
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    total = int(made.sum())
    first = np.cumsum(counts) - counts
    before = np.cumsum(made) - made
    owner_shift = np.repeat(first - before, made)
    at = np.arange(total, dtype=np.int64) + owner_shift
    size = np.repeat(np.minimum(counts, width), made)
    sums = size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    padded = np.concatenate([hashed, np.zeros(width, np.uint64)])
    for k in range(width):
        part = padded[at + k] * _FACTORS[k]
        sums += part if width == 1 else np.where(size > k, part, np.uint64(0))
    return mix(sums), made


def text_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, stops, counts = words(data, offsets)
    return shingle_hashes(word_hashes(data, starts, stops), counts)
