"""Vectors as codes of eight bytes: whole-number codebooks per part, nearest entries found in a GNAT.

Every component becomes floor(4096 * x); all that follows is exact in whole numbers. A round
assigns the parts of all vectors to the nearest entries of their codebooks and replaces every
entry by the floored mean of its parts. Tasks sum parts as they read, Spark adds the sums, and
only the entries themselves (16 vectors) reach the driver.

The nearest entry is found in a geometric near-neighbour access tree over a codebook: split
points know the range of distances to what lies under each of them, and a subtree is left out
only where the triangle inequality, with roots rounded to its disfavour, proves all of it
strictly farther than the best entry so far. What remains is settled by squared distances in
whole numbers, ties by the lower index.

Rows whose vector is null or holds null or non-finite numbers are dropped. A vector's length
is that of the vector of the smallest id; a length that is no multiple of eight counts as
filled up with zeros. Vectors of another length, and all if no row has an id, get null for
code and error. Rows without id are coded but never start a codebook; of an id that repeats,
the smallest vector does. With fewer than 16 ids a codebook has as many entries. Equal labels,
null among them, share ``label_error``, which leaves null errors out. Errors above 2**63 - 1
are null. Tables without rows give none; columns other than the three named are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendframe.llm.arrow import column
from lendframe.session import cut_lineage

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node of the tree.
DEGREE = 4
#: Sums are added in pieces of so many bits once they need more than PLAIN.
LIMB, PLAIN = 30, 36
_LONG = 1 << 63


def whole(values: np.ndarray) -> np.ndarray:
    """floor(4096 * x) as int64, as Python integers where that might not hold them."""
    if not values.size or np.abs(values).max() < 2.0**40:
        return np.floor(values * SCALE).astype(np.int64)
    exact = [int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(x * SCALE) for x in values.ravel().tolist()]
    return np.array(exact, object).reshape(values.shape)


def _largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def _fitting(values: np.ndarray, largest: int, length: int) -> np.ndarray:
    """int64 if sums of squared differences fit, else Python integers."""
    safe = (2 * largest) ** 2 * max(length, 1) < _LONG // 2
    return values.astype(np.int64 if safe else object)


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers that the square roots are surely not below and not above."""
    if squares.dtype == object:
        low = np.array([math.isqrt(x) for x in squares.ravel().tolist()], object).reshape(squares.shape)
        return low, low + 1
    near = np.sqrt(squares.astype(np.float64)).astype(np.int64)
    return near - 1, near + 2


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


class Node:
    """Of entries in Python integers: split points of some entries, and for every two of them the least and largest distance from the one to what lies under the other."""

    def __init__(self, entries: np.ndarray, own: list[int]):
        self.splits = own[:1]
        while len(self.splits) < min(DEGREE, len(own)):
            rest = [k for k in own if k not in self.splits]
            self.splits.append(max(rest, key=lambda k: (min(int(_squared(entries[k], entries[s])) for s in self.splits), -k)))
        under: list[list[int]] = [[] for _ in self.splits]
        for k in own:
            if k not in self.splits:
                under[min(range(len(self.splits)), key=lambda s: (int(_squared(entries[k], entries[self.splits[s]])), s))].append(k)
        self.children = [Node(entries, u) if u else None for u in under]
        self.least, self.most = [], []
        for s in self.splits:
            spans = [[int(_squared(entries[s], entries[k])) for k in u] for u in under]
            self.least.append([math.isqrt(min(x)) if x else 0 for x in spans])
            self.most.append([math.isqrt(max(x)) + 1 if x else 0 for x in spans])


class Gnat:
    """Nearest entry of a codebook, for many parts at once."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.root = entries, Node(entries.astype(object), list(range(len(entries))))

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each part; of equally near ones the first."""
        largest = max(_largest(parts), _largest(self.entries))
        parts, entries = (_fitting(x, largest, parts.shape[1] * PARTS) for x in (parts, self.entries))
        index = np.full(len(parts), len(entries), np.int64)
        best = np.full(len(parts), _LONG - 1, np.int64) if parts.dtype != object else np.array([4 * (2 * largest + 1) ** 2 * (parts.shape[1] + 1)] * len(parts), object)

        def visit(node: Node, rows: np.ndarray) -> None:
            squares = np.stack([_squared(parts[rows], entries[s]) for s in node.splits], axis=1)
            for at, split in enumerate(node.splits):
                d = squares[:, at]
                better = (d < best[rows]) | ((d == best[rows]) & (split < index[rows]))
                best[rows[better]], index[rows[better]] = d[better], split
            low, high = _roots(squares)
            for child, below in enumerate(node.children):
                if below is None:
                    continue
                reach = _roots(best[rows])[1]
                open_ = np.ones(len(rows), bool)
                for at in range(len(node.splits)):
                    open_ &= ((low[:, at] - reach <= node.most[at][child]) & (high[:, at] + reach >= node.least[at][child])).astype(bool)
                if open_.any():
                    visit(below, rows[open_])

        if len(parts):
            visit(self.root, np.arange(len(parts)))
        return index, best


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Whole components by vector, part and place in the part."""
    values = column(batch, "embedding").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    filled = np.zeros((batch.num_rows, PARTS * width))
    filled[:, : values.shape[1]] = values
    return whole(filled).reshape(batch.num_rows, PARTS, width)


def _starts(usable: DataFrame) -> tuple[int, np.ndarray] | None:
    """Length of vectors, and the vectors of the smallest ids."""
    known = usable.filter("vec_id is not null")
    first = known.orderBy("vec_id", "embedding").limit(1).collect()
    if not first:
        return None
    length, found = len(first[0]["embedding"]), {}
    known = left = known.filter(F.size("embedding") == length)
    # ids that repeat take further looks; each ends beyond the last id seen
    while len(found) < ENTRIES and (rows := left.orderBy("vec_id", "embedding").limit(ENTRIES).collect()):
        for r in rows:
            if len(found) < ENTRIES:
                found.setdefault(r["vec_id"], r["embedding"])
        left = known.filter(F.col("vec_id") > F.lit(rows[-1]["vec_id"]))
    width = -(-length // PARTS)
    filled = np.zeros((len(found), PARTS * width))
    filled[:, :length] = np.array(list(found.values()), np.float64).reshape(len(found), length)
    return length, whole(filled).reshape(len(found), PARTS, width).transpose(1, 0, 2)


def _pieces(total: int) -> Iterator[tuple[int, int]]:
    """A sum as pieces ``(k, x)`` of x * 2 ** (LIMB * k)."""
    k = 0
    while not -(1 << PLAIN) < total < 1 << PLAIN:
        yield k, total & ((1 << LIMB) - 1)
        total >>= LIMB
        k += 1
    yield k, total


def improve(fitting: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: codebooks (part, entry, place) whose entries are the floored means of the parts nearest to them."""
    parts, entries, width = books.shape
    trees = [Gnat(b) for b in books]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch, width)
            made = []
            for part, tree in enumerate(trees):
                index, _ = tree.nearest(vectors[:, part])
                order = np.argsort(index, kind="stable")
                used, first, times = np.unique(index[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(vectors[order, part], first, axis=0) if width else np.zeros((len(used), 0), np.int64)
                for entry, own, n in zip(used.tolist(), sums.tolist(), times.tolist(), strict=True):
                    slot = (part * entries + entry) * (width + 1)
                    made += [(slot + at, k, x) for at, total in enumerate([*own, n]) for k, x in _pieces(int(total))]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made, strict=True)], ["slot", "piece", "total"])

    summed = fitting.select("embedding").mapInArrow(add, "slot long, piece long, total long").groupBy("slot", "piece").agg(F.sum("total").alias("total"))
    totals: dict[int, int] = {}
    for r in summed.collect():
        totals[r["slot"]] = totals.get(r["slot"], 0) + (r["total"] << (LIMB * r["piece"]))
    better = books.astype(object)
    for k in range(parts * entries):
        count = totals.get(k * (width + 1) + width, 0)
        if count:
            better[k // entries, k % entries] = [totals.get(k * (width + 1) + at, 0) // count for at in range(width)]
    return _fitting(better, _largest(better), 1)


def learn(usable: DataFrame, rounds: int = ROUNDS) -> tuple[int, np.ndarray] | None:
    """Length of vectors and codebooks after some rounds over all vectors; None without ids."""
    start = _starts(usable)
    if start is None:
        return None
    length, books = start
    fitting = usable.filter(F.size("embedding") == length)
    for _ in range(rounds):
        books = improve(fitting, books)
    return length, books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of vectors of the right length."""
    trees, width = [Gnat(b) for b in books], books.shape[2]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _vectors(batch, width)
            found = [tree.nearest(vectors[:, part]) for part, tree in enumerate(trees)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            errors = [e if e < _LONG else None for e in sum(best for _, best in found).tolist()]
            columns = [column(batch, "vec_id"), column(batch, "label"), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return rows.select("vec_id", "label", "embedding").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(table: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = cut_lineage(table.select("vec_id", "label", "embedding").filter(F.col("embedding").isNotNull()).filter(finite))
    learned = learn(usable)
    length, books = learned or (-1, np.zeros((PARTS, 0, 0), np.int64))
    fitting = F.size("embedding") == length
    blank = usable.filter(~fitting).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = cut_lineage(encode(usable.filter(fitting), books).unionAll(blank) if learned else blank)
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38, 0)")).try_cast("long").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    joined = coded.join(cut_lineage(sums), F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle() -> str:
    """The same in SQL, a table per round."""
    distance = "list_sum(list_transform(list_zip(parts.v, book.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT"
    mean = "((s - ((s % n) + n) % n) // n)::BIGINT"
    steps = [
        "kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        "parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * (len(v) // 8) + 1 : (p + 1) * (len(v) // 8)] AS v FROM kept, range(8) r(p))",
        "b0 AS MATERIALIZED (SELECT p, e, v FROM (SELECT p, v, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 16)",
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"a{k} AS MATERIALIZED (SELECT vec_id, p, any_value(label) AS label, any_value(v) AS v, min({{'d': d, 'e': e}}) AS best"
            f" FROM (SELECT vec_id, label, p, parts.v, e, {distance} AS d FROM parts JOIN b{k} book USING (p)) GROUP BY vec_id, p)"
        )
        if k < ROUNDS:
            steps.append(
                f"b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, o.v) AS v FROM b{k} o LEFT JOIN (SELECT p, e, list({mean} ORDER BY i) AS v FROM"
                f" (SELECT p, e, i, sum(x) AS s, count(*) AS n FROM (SELECT p, best.e AS e, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}) GROUP BY p, e, i)"
                " GROUP BY p, e) m USING (p, e))"
            )
    steps += [
        f"coded AS (SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d) AS error FROM a{ROUNDS} GROUP BY vec_id)",
        f"digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{ROUNDS})",
    ]
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, digest"
