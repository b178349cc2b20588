"""Benchmark passages in documents, by SimHash over item-sized windows.

Item and document are sequences of word shingles (five words, A to Z lower-cased). For an
item of s shingles a document's windows are its runs of s shingles, or the whole document
if it has fewer. A window's SimHash is 64 bits, each the sign of a sum over its shingles,
repeats counted. Fingerprints are cut into blocks: two that differ in at most RADIUS bits
agree up to RADIUS // BLOCKS bits in some block, so a table per block that files each item
under all values that near finds every item within the radius. Each candidate is verified
by weighted Jaccard similarity, the weight of a shingle being how often it occurs.

Windows that share no shingle with any item of their size have similarity 0 and are not
hashed. The radius lies above four standard deviations of the distance of fingerprints at
the least similarity, so that pairs at it are practically never missed.

Items are taken in blocks of about ITEMS and ITEM_BYTES, one pass over the documents per block. Items and
documents without words match nothing; null texts count as empty; items of fewer than five
words match the same words in a row. Repeated rows of either side get rows each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lendframe.llm.arrow import chunks, column, utf8
from lendframe.llm.shingles import WIDTH, mix, shingle_hashes, word_hashes, words

LEAST = 0.8
RADIUS = 23
BLOCKS = 8
BITS = 64
#: Items of one pass; their shingles and tables go to every task.
ITEMS = 20_000
#: And their texts, in bytes.
ITEM_BYTES = 64 << 20
_BLOCK_BITS = BITS // BLOCKS
_SHIFTS = np.arange(BITS, dtype=np.uint64)


def sign_rows(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each bit of each shingle."""
    return ((hashes[:, None] >> _SHIFTS) & np.uint64(1)).astype(np.int32) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _SHIFTS).sum(axis=1, dtype=np.uint64)


def fingerprint(hashes: np.ndarray) -> np.uint64:
    return pack(sign_rows(mix(hashes)).sum(axis=0, keepdims=True))[0]


def weighted_similarity(left: np.ndarray, right: np.ndarray) -> float:
    """Sum of the lesser over sum of the greater counts."""
    a, n = np.unique(left, return_counts=True)
    b, m = np.unique(right, return_counts=True)
    both, at, to = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = int(np.minimum(n[at], m[to]).sum())
    return shared / (len(left) + len(right) - shared) if len(left) and len(right) else 0.0


class ItemIndex:
    """Items of one pass: who holds each shingle, and block tables by size."""

    def __init__(self, ids: list, texts: list[str]):
        self.ids, self.items, self.words = [], [], []
        data, offsets = utf8(pa.array(texts, pa.string()))
        starts, stops, counts = words(data, offsets)
        hashed, made = shingle_hashes(word_hashes(data, starts, stops), counts)
        ends = np.cumsum(made)
        for k, n in enumerate(made.tolist()):
            if n:
                self.ids.append(ids[k])
                self.items.append(hashed[ends[k] - n : ends[k]])
                self.words.append(int(counts[k]))
        #: Items under five words are looked for among runs of so many words.
        self.groups: dict[int, list[int]] = {}
        for k, n in enumerate(self.words):
            self.groups.setdefault(min(n, WIDTH), []).append(k)
        self.holders: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.near: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]] = {}
        for width, members in self.groups.items():
            sizes = np.concatenate([np.full(len(self.items[k]), len(self.items[k])) for k in members])
            pairs = np.unique(np.stack([np.concatenate([self.items[k] for k in members]), sizes.astype(np.uint64)]), axis=1)
            seen = np.zeros(1 << 22, bool)
            seen[(pairs[0] & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.holders[width] = (seen, pairs[0], pairs[1].astype(np.int64))
            for size in np.unique(sizes).tolist():
                own = [k for k in members if len(self.items[k]) == size]
                prints = np.array([fingerprint(self.items[k]) for k in own], np.uint64)
                self.near[width, size] = (prints, *self._tables(prints), own)

    @staticmethod
    def _tables(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per block and block value, the items within reach: offsets and members."""
        reach = RADIUS // BLOCKS
        values = np.arange(1 << _BLOCK_BITS)
        keys, members = [], []
        for block in range(BLOCKS):
            own = ((prints >> np.uint64(block * _BLOCK_BITS)) & np.uint64((1 << _BLOCK_BITS) - 1)).astype(np.int64)
            member, value = np.nonzero(np.bitwise_count(own[:, None] ^ values) <= reach)
            keys.append(block * len(values) + value)
            members.append(member)
        keys, members = np.concatenate(keys), np.concatenate(members)
        order = np.argsort(keys, kind="stable")
        return np.searchsorted(keys[order], np.arange(BLOCKS * len(values) + 1)), members[order]

    def candidates(self, width: int, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of window and item within the radius."""
        own, offsets, members, _ = self.near[width, size]
        found = []
        for block in range(BLOCKS):
            value = ((prints >> np.uint64(block * _BLOCK_BITS)) & np.uint64((1 << _BLOCK_BITS) - 1)).astype(np.int64) + (block << _BLOCK_BITS)
            counts = offsets[value + 1] - offsets[value]
            window = np.repeat(np.arange(len(prints)), counts)
            before = np.cumsum(counts) - counts
            at = np.arange(int(counts.sum())) - np.repeat(before, counts) + np.repeat(offsets[value], counts)
            found.append(window * len(own) + members[at])
        pairs = np.unique(np.concatenate(found))
        window, item = pairs // len(own), pairs % len(own)
        close = np.bitwise_count(prints[window] ^ own[item]) <= RADIUS
        return window[close], item[close]

    def search(self, hashed: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
        """Matches of a chunk of documents: row, item id, similarity, first word, words."""
        for width in self.groups:
            grams, made = shingle_hashes(hashed, counts, width)
            seen, keys, sizes = self.holders[width]
            hits = np.flatnonzero(seen[(grams & np.uint64((1 << 22) - 1)).astype(np.int64)])
            low, high = np.searchsorted(keys, grams[hits]), np.searchsorted(keys, grams[hits], "right")
            hits, low, high = hits[high > low], low[high > low], high[high > low]
            if not len(hits):
                continue
            ends = np.cumsum(made)
            rows = np.searchsorted(ends, hits, "right")
            count = high - low
            size = sizes[np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)]
            hit, row = np.repeat(hits, count), np.repeat(rows, count)
            order = np.lexsort((hit, size, row))
            hit, row, size = hit[order], row[order], size[order]
            heads = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (size[1:] != size[:-1])])
            for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(hit)], strict=True):
                r, s = int(row[a]), int(size[a])
                end = int(ends[r])
                yield from self._windows(grams, hit[a:b], width, s, r, end - int(made[r]), end, int(counts[r]))

    def _windows(self, grams, hits, width, size, row, low, high, n_words):
        """Windows of ``size`` shingles over any of the hits, in the document from low to high."""
        size_here = min(size, high - low)
        marks = np.zeros(high - low + 1, np.int32)
        np.add.at(marks, np.maximum(hits - size_here + 1, low) - low, 1)
        np.add.at(marks, np.minimum(hits, high - size_here) + 1 - low, -1)
        starts = np.flatnonzero(np.cumsum(marks[:-1]) > 0) + low
        first = int(starts[0])
        sums = np.cumsum(sign_rows(mix(grams[first : int(starts[-1]) + size_here])), axis=0)
        sums = np.vstack([np.zeros((1, BITS), sums.dtype), sums])
        prints = pack(sums[starts - first + size_here] - sums[starts - first])
        best: dict[int, tuple[float, int]] = {}
        own = self.near[width, size][3]
        for window, item in zip(*self.candidates(width, size, prints), strict=True):
            at = int(starts[window])
            similar = weighted_similarity(grams[at : at + size_here], self.items[own[item]])
            if similar >= LEAST and similar > best.get(int(item), (0.0, 0))[0]:
                best[int(item)] = (similar, at - low)
        for item, (similar, at) in best.items():
            yield row, self.ids[own[item]], similar, at, min(n_words - at, self.words[own[item]])


def _passes(benchmark: DataFrame) -> list[DataFrame]:
    rows, size = benchmark.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    count = max(1, -(-rows // ITEMS), -(-size // ITEM_BYTES))
    block = F.pmod(F.xxhash64("item_id"), F.lit(count))
    return [benchmark.filter(block == k) for k in range(count)]


def _index(items: DataFrame):
    rows = items.select("item_id", "text").filter("text is not null").orderBy("item_id").collect()
    return items.sparkSession.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows]))


def _search(index: ItemIndex, text: pa.Array) -> list[tuple[int, int, float, int, int]]:
    data, offsets = utf8(text)
    starts, stops, counts = words(data, offsets)
    return list(index.search(word_hashes(data, starts, stops), counts))


def drop_leaked(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    for items in _passes(benchmark):
        docs = docs.filter(~_leaked(_index(items))(F.col("text")))
    return docs


def _leaked(index):
    @F.arrow_udf("boolean")
    def leaked(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in arrays:
            out = np.zeros(len(text), bool)
            for a, b in chunks(text):
                out[[a + match[0] for match in _search(index.value, text[a:b])]] = True
            yield pa.array(out)

    return leaked


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words``: each document and item that match, at their best window."""
    return reduce(DataFrame.unionByName, [_one_pass(docs, items) for items in _passes(benchmark)])


def _one_pass(docs: DataFrame, items: DataFrame) -> DataFrame:
    index = _index(items)
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType
    schema = f"doc_id {kind}, item_id {item_kind.simpleString()}, similarity double, first_word long, n_words long"
    names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
    arrow_item = to_arrow_type(item_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text = column(batch, "doc_id"), column(batch, "text")
            for a, b in chunks(text):
                found = _search(index.value, text[a:b])
                if found:
                    row, item, similar, at, n = zip(*found, strict=True)
                    columns = [doc[a:b].take(pa.array(row)), pa.array(item, arrow_item), pa.array(similar, pa.float64()), pa.array(at, pa.int64()), pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
