"""Locally consistent names for word sequences: rounds of run and pair compression.

A round first names the inside of every run of equal symbols, then names pairs of neighbours
``left right``, where a bit drawn from a symbol's name makes it left or right. Names are
64-bit digests of what they stand for, so equal content has equal names in all tasks. Whether
two symbols are joined depends on them alone; so of a window of words only symbols at its two
ends can be named otherwise at another place, and what lies between, its core, is the same
wherever the window occurs.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from lendframe.llm.arrow import ragged
from lendframe.llm.shingles import mix

_PAIR, _RUN, _SIDE = (np.uint64(x) for x in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD1B54A32D192ED03))

_RADIX = 0x9E3779B97F4A7C15
#: From this level on it pays to look for neighbours with one core.
JOINED = 3
#: A random value per byte.
_BYTES = mix(np.arange(256, dtype=np.uint64) + np.uint64(77_000))
_known: list[np.ndarray] = []
#: Bytes of words that are named at once.
PART = 1 << 19


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _known or len(_known[0]) < n + 1:
        size = 1 << n.bit_length()
        for k, radix in enumerate((_RADIX, pow(_RADIX, -1, 1 << 64))):
            steps = np.full(size, radix, np.uint64)
            steps[0] = 1
            _known[k : k + 1] = [np.multiply.accumulate(steps)]
    return _known


def joined(a: np.ndarray, b: np.ndarray, factor: np.uint64) -> np.ndarray:
    """Name of a symbol followed by another, or of a symbol so many times."""
    return mix(mix(a ^ factor) * factor + b)


class Level(NamedTuple):
    """Symbols of some texts: names, the text of each, and its first word."""

    names: np.ndarray
    text: np.ndarray
    first: np.ndarray


def compress_runs(level: Level) -> tuple[Level, np.ndarray, np.ndarray, np.ndarray] | None:
    """The level with the inside of runs as one symbol each; where symbols went; equal symbols from each on, and up to each.

    The first and the last of a run stay as they are: so a symbol at the end of a window that
    differs from its neighbour inside is kept, whatever lies outside. None if no symbol repeats.
    """
    names, text, first = level
    n = len(names)
    same = np.zeros(n, bool)
    same[1:] = (names[1:] == names[:-1]) & (text[1:] == text[:-1])
    if not same.any():
        return None
    head = np.flatnonzero(~same)
    size = np.diff(np.append(head, n))
    at = np.arange(n) - np.repeat(head, size)
    up_to, on = at + 1, np.repeat(size, size) - at
    inside = (at > 0) & (on > 1)
    kept = ~inside | (at == 1)
    moved = np.cumsum(kept) - 1
    named = names.copy()
    run = np.flatnonzero(inside & (at == 1))
    named[run] = joined(names[run], (on + at)[run].astype(np.uint64), _RUN)
    return Level(named[kept], text[kept], first[kept]), moved, on, up_to


def compress_pairs(level: Level, depth: int) -> tuple[Level, np.ndarray, np.ndarray]:
    """The level with neighbours of kind left, right as one symbol; where symbols went; which are right."""
    names, text, first = level
    right = (mix(names ^ mix(_SIDE + np.full(1, depth, np.uint64))) >> np.uint64(63)).astype(bool)
    second = np.zeros(len(names), bool)
    second[1:] = right[1:] & ~right[:-1] & (text[1:] == text[:-1])
    moved = np.cumsum(~second) - 1
    named = names.copy()
    at = np.flatnonzero(second)
    named[at - 1] = joined(names[at - 1], names[at], _PAIR)
    return Level(named[~second], text[~second], first[~second]), moved, right


def word_names(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A name of every word, by all its bytes as they are."""
    parts, at = [np.zeros(0, np.uint64)], 0
    while at < len(starts):
        # so many words as lie in a part of the bytes, one at least
        end = max(int(np.searchsorted(stops, starts[at] + PART, "right")), at + 1)
        low, own, ends = starts[at], starts[at:end] - starts[at], stops[at:end] - starts[at]
        power, inverse = _powers(int(ends[-1]))
        sums = np.zeros(int(ends[-1]) + 1, np.uint64)
        np.cumsum(_BYTES[data[low : low + ends[-1]]] * power[: ends[-1]], out=sums[1:])
        parts.append(mix((sums[ends] - sums[own]) * inverse[own] ^ (ends - own).astype(np.uint64)))
        at = end
    return np.concatenate(parts)


def window_names(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of 64 bits and 32 more bits of the windows that begin at the given words."""
    power, inverse = _powers(len(words))
    names = []
    for salt in (0, 1):
        values = mix(words + _SIDE) if salt else words
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * power[: len(words)], dtype=np.uint64)])
        names.append(mix((sums[starts + width] - sums[starts]) * inverse[starts]))
    return names[0], (names[1] >> np.uint64(32)).astype(np.uint32)


def windows(counts: np.ndarray, width: int) -> np.ndarray:
    """First words of all windows of ``width`` words that lie inside a text."""
    own = np.maximum(counts - width + 1, 0)
    return ragged(np.cumsum(counts) - counts, own)


class Anchors(NamedTuple):
    """Runs of neighbouring windows with one anchor: number of the first window, how many, name and first word of the anchor."""

    window: np.ndarray
    size: np.ndarray
    names: np.ndarray
    places: np.ndarray


def anchors(words: np.ndarray, counts: np.ndarray, width: int) -> Anchors:
    """The anchors of all windows inside a text, in order: of each the first symbol of its last core.

    The core is followed upwards while it holds more than one run: what remains is named by
    the content of the window alone, so equal windows have equal names, at equal places in them.
    Neighbouring windows whose cores meet are followed as one from there on.
    """
    low = windows(counts, width)
    high, window, size, depth = low + width, np.arange(len(low)), np.ones(len(low), np.int64), 0
    level = Level(words, np.repeat(np.arange(len(counts)), counts), np.arange(len(words)))
    found: list[tuple[np.ndarray, ...]] = []
    while len(low):
        runs = compress_runs(level)
        if runs is None:
            squeezed, next_low, next_high, open_ = level, low, high, high - low > 1
        else:
            squeezed, moved, on, up_to = runs
            ahead = on[low]
            open_ = ahead < high - low
            next_low, next_high = moved[low + ahead - 1], moved[high - up_to[high - 1]] + 1
        lifted, moved, right = compress_pairs(squeezed, depth)
        next_low, next_high = next_low + right[next_low], next_high - ~right[next_high - 1]
        open_ &= next_low < next_high
        if not open_.all():
            done = np.flatnonzero(~open_)
            found.append((window[done], size[done], level.names[low[done]], level.first[low[done]]))
            next_low, next_high, window, size = (x[open_] for x in (next_low, next_high, window, size))
        low, high = moved[next_low], moved[next_high - 1] + 1
        level, depth = lifted, depth + 1
        if depth < JOINED or not len(low):
            continue
        # neighbours with one core go on as one
        head = np.ones(len(low), bool)
        head[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1]) | (window[1:] != window[:-1] + size[:-1])
        at = np.flatnonzero(head)
        size = np.add.reduceat(size, at)
        low, high, window = low[at], high[at], window[at]
    if not found:
        return Anchors(*(np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.int64)))
    window, size, names, places = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(window, kind="stable")
    return Anchors(window[order], size[order], names[order], places[order])
