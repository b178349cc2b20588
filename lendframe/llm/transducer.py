"""Minimal acyclic transducers: sorted terms to their lexicographic ordinals and back."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

import numpy as np

from lendframe.llm.shingles import mix


class Transducer(NamedTuple):
    """Arcs ``(state << 8 | byte) -> target``, each with the number of terms that come before it.

    The ordinal of a term is the sum of ``skips`` along its path. ``ends`` tells in which
    states a term may end; the root is the last state.
    """

    keys: np.ndarray
    targets: np.ndarray
    skips: np.ndarray
    ends: np.ndarray

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """Of distinct terms in ascending order, state by state.

        What follows a prefix is complete as soon as a term leaves that prefix; it is then
        replaced by an equal state met before, if there is one.
        """
        states: dict[tuple, int] = {}
        below: list[int] = []
        path: list[list] = [[False, []]]
        previous = b""

        def close(depth: int) -> None:
            while len(path) > depth:
                end, arcs = path.pop()
                form = (end, tuple(arcs))
                state = states.get(form)
                if state is None:
                    state = states[form] = len(below)
                    below.append(end + sum(below[target] for _, target in arcs))
                if path:
                    path[-1][1].append((previous[len(path) - 1], state))

        for term in terms:
            shared = 0
            for x, y in zip(previous, term):
                if x != y:
                    break
                shared += 1
            close(shared + 1)
            path.extend([False, []] for _ in term[shared:])
            path[-1][0] = True
            previous = term
        close(1)
        # the root stays a state of its own, and the last one
        end, arcs = path.pop()
        states[(end, tuple(arcs), "root")] = len(below)
        keys, targets, skips, ends = [], [], [], np.zeros(len(states), bool)
        for (end, arcs, *_), state in states.items():
            ends[state] = before = end
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                targets.append(target)
                skips.append(int(before))
                before += below[target]
        return cls(np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int32), ends)

    def term(self, ordinal: int) -> bytes:
        """The term of an ordinal: of the arcs of a state, the last that skips no more than is left."""
        first = np.searchsorted(self.keys, np.arange(len(self.ends) + 1, dtype=np.int64) << 8)
        state, out = len(self.ends) - 1, bytearray()
        while True:
            arcs = slice(first[state], first[state + 1])
            at = int(np.searchsorted(self.skips[arcs], ordinal, "right")) - 1
            if at < 0 or (ordinal == 0 and self.ends[state]):
                return bytes(out)
            arc = first[state] + at
            out.append(int(self.keys[arc]) & 0xFF)
            ordinal -= int(self.skips[arc])
            state = int(self.targets[arc])


class Streamer:
    """Several transducers as one table of arcs that many words walk at once, byte by byte.

    Those of one ``group`` hold consecutive ranges of its terms. The first eight bytes of a
    word tell which of them can hold it.
    """

    def __init__(self, parts: list[tuple[int, bytes, int, int, Transducer]]):
        """Parts are ``(group, first term, number, offset, transducer)``, in ascending order of groups and terms."""
        sizes = np.array([len(p[4].ends) for p in parts], np.int64)
        base = np.cumsum(sizes) - sizes
        self.roots = base + sizes - 1
        self.offsets = np.array([p[3] for p in parts], np.int64)
        self.numbers = np.array([p[2] for p in parts], np.int64)
        self.groups = np.array([p[0] for p in parts], np.int64)
        self.heads = np.array([int.from_bytes(p[1][:8].ljust(8, b"\0"), "big") for p in parts], np.uint64)
        self.ends = np.concatenate([p[4].ends for p in parts])
        self.keys = np.concatenate([p[4].keys + (b << 8) for p, b in zip(parts, base)])
        self.targets = np.concatenate([p[4].targets + b for p, b in zip(parts, base)])
        self.skips = np.concatenate([p[4].skips for p in parts])
        self._fill()

    def _fill(self) -> None:
        """Open addressing with at most half of the places taken."""
        self.mask = np.uint64((1 << max(4, (2 * len(self.keys)).bit_length())) - 1)
        self.places = np.full(int(self.mask) + 1, -1, np.int64)
        at, waiting = self._place(self.keys), np.arange(len(self.keys))
        while len(waiting):
            free = self.places[at] < 0
            self.places[at[free]] = waiting[free]
            lost = self.places[at] != waiting
            at, waiting = (at[lost] + 1) & int(self.mask), waiting[lost]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(np.uint64)) & self.mask).astype(np.int64)

    def _arcs(self, keys: np.ndarray) -> np.ndarray:
        """The arc of every key, -1 where there is none."""
        at = self._place(keys)
        arc = self.places[at]
        open_ = np.flatnonzero((arc >= 0) & (self.keys[arc] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & int(self.mask)
            arc[open_] = self.places[at[open_]]
            open_ = open_[(arc[open_] >= 0) & (self.keys[arc[open_]] != keys[open_])]
        return arc

    def _walk(self, data: np.ndarray, at: np.ndarray, stops: np.ndarray, part: np.ndarray) -> np.ndarray:
        """Ordinals within the group of the words that the given parts hold, else -1."""
        found = np.full(len(at), -1, np.int64)
        word, state, total = np.arange(len(at)), self.roots[part], self.offsets[part]
        while len(word):
            arc = self._arcs((state << 8) | data[at])
            live = arc >= 0
            arc, word, at, stops = arc[live], word[live], at[live] + 1, stops[live]
            state, total = self.targets[arc], total[live] + self.skips[arc]
            done = at == stops
            if done.any():
                good = done & self.ends[state]
                found[word[good]] = total[good]
                word, at, stops, state, total = word[~done], at[~done], stops[~done], state[~done], total[~done]
        return found

    def look_up(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ordinal of every word within its group and number of the part that holds it; -1 for none."""
        heads = np.zeros(len(starts), np.uint64)
        padded = np.concatenate([data, np.zeros(8, np.uint8)])
        for k in range(8):
            heads = (heads << np.uint64(8)) | np.where(starts + k < stops, padded[starts + k], 0).astype(np.uint64)
        ordinals, parts = np.full(len(starts), -1, np.int64), np.full(len(starts), -1, np.int64)
        for group in np.unique(groups[groups >= 0]).tolist():
            low, high = np.searchsorted(self.groups, [group, group + 1])
            own = np.flatnonzero(groups == group)
            first = np.maximum(np.searchsorted(self.heads[low:high], heads[own], "left") - 1, 0) + low
            last = np.searchsorted(self.heads[low:high], heads[own], "right") - 1 + low
            while len(own):
                fits = first <= last
                own, first, last = own[fits], first[fits], last[fits]
                found = self._walk(data, starts[own], stops[own], first)
                hit = found >= 0
                ordinals[own[hit]], parts[own[hit]] = found[hit], self.numbers[first[hit]]
                own, first, last = own[~hit], first[~hit] + 1, last[~hit]
        return ordinals, parts
