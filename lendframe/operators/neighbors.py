"""Exact distance to the k-th nearest neighbour, as a partitioned join.

Equal points are folded into one with a count. Median splits of a sample, a tree, cut
space into cells of about CELL_POINTS points, so the number of cells follows the data and
the work per cell does not. Each cell finds an upper bound for its own points; a point then
walks the tree, and where its bound reaches other cells it visits these and its own once more.
Within a cell a small tree of the same kind rules out most points. Candidates never leave a
task except as the few nearest of points that visit, so no pairs are materialised.

The driver holds SAMPLE_PER_CELL sampled points a cell to make the tree, and every task the
tree and its boxes, 180 bytes a cell with five features: 22 MB for 10 ** 9 distinct points.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..eras import INDEX_COLUMN
from ..functions.casts import col
from ..session import cut_lineage
from .quantiles import exact_quantiles
from .splits import unit_hash

# Model settings of the published analysis.
NEIGHBORS = 15
CONTAMINATION = 0.005
FEATURES = (
    "loan_amount",
    "property_value",
    "combined_loan_to_value_ratio",
    "loan_purpose",
    "activity_year",
)

CELL_POINTS = 8192
#: Points in a leaf of the tree inside a cell.
LEAF_POINTS = 64
#: Random trees that bounds are taken from.
TABLES = 3
#: Points that trees after the first look for, as a multiple of the outliers wanted.
LOOKED_AGAIN = 8
SAMPLE_PER_CELL = 32
SAMPLE_FLOOR = 4096
BLOCK = 1 << 20
VISITORS = 8192
QUERIES_PER_TASK = 50_000
NEAREST = "distance array<double>, copies_near array<bigint>"


def _middle(values: np.ndarray) -> float:
    """The median, or the next value below where nothing would lie above it."""
    median = np.median(values)
    if median < values.max():
        return median
    below = values[values < median]
    return below.max() if len(below) else median


def _splits(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Median splits on the widest side, in heap order."""
    dims = np.zeros(2**levels, dtype=int)
    cuts = np.zeros(2**levels)
    parts = {1: np.arange(len(sample))}
    for node in range(1, 2**levels):
        members = parts.pop(node)
        inside = sample[members]
        if len(members):
            dim = int(np.argmax(inside.max(axis=0) - inside.min(axis=0)))
            dims[node], cuts[node] = dim, _middle(inside[:, dim])
        over = inside[:, dims[node]] > cuts[node]
        parts[2 * node], parts[2 * node + 1] = members[~over], members[over]
    return dims, cuts


def _place(values: np.ndarray, dims: np.ndarray, cuts: np.ndarray, levels: int) -> np.ndarray:
    """Heap index of the leaf of every row."""
    at = np.ones(len(values), dtype=int)
    rows = np.arange(len(values))
    for _ in range(levels):
        at = 2 * at + (values[rows, dims[at]] > cuts[at])
    return at


def _nearest(
    queries: np.ndarray, points: np.ndarray, copies: np.ndarray, k: int, own: int, reach: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per query: ascending distances of the ``k + 1`` nearest points, infinite where there are fewer, and their copies.

    ``own`` is added to the copies of the point that a query is itself. With ``reach`` only
    what lies closer is sure to be among them.
    """
    levels = max(0, math.ceil(math.log2(max(1.0, len(points) / max(LEAF_POINTS, 2 * k)))))
    dims, cuts = _splits(points, levels)
    leaf = _place(points, dims, cuts, levels)
    order = np.argsort(leaf, kind="stable")
    held = points[order]
    leaves, firsts = np.unique(leaf[order], return_index=True)
    low, high = _tree_boxes(leaves, np.minimum.reduceat(held, firsts), np.maximum.reduceat(held, firsts), levels)
    members = {n: (held[i:j], copies[order[i:j]]) for n, i, j in zip(leaves.tolist(), firsts, [*firsts[1:], len(held)], strict=True)}
    # an equal value on all sides adds nothing to a distance
    varied = [d for d in range(points.shape[1]) if np.ptp(points[:, d]) or (queries[:, d] != points[0, d]).any()]
    squares = np.full((len(queries), k + 1), math.inf)
    counts = np.zeros((len(queries), k + 1), dtype=np.int64)

    def look(rows: np.ndarray, at: int) -> None:
        near, near_copies = members.get(at, (held[:0], copies[:0]))
        step = max(1, BLOCK // (len(near) + k + 1))
        for start in range(0, len(rows) if len(near) else 0, step):
            part = rows[start : start + step]
            block = queries[part]
            found = np.zeros((len(block), len(near)))
            for dim in varied:
                found += (block[:, dim, None] - near[None, :, dim]) ** 2
            count = np.repeat(near_copies[None, :], len(block), axis=0)
            i, j = np.nonzero(found == 0)
            same = (block[i] == near[j]).all(axis=1)
            count[i[same], j[same]] += own
            found = np.concatenate([squares[part], found], axis=1)
            count = np.concatenate([counts[part], count], axis=1)
            best = np.argpartition(found, k, axis=1)[:, : k + 1]
            squares[part] = np.take_along_axis(found, best, axis=1)
            counts[part] = np.take_along_axis(count, best, axis=1)

    def look_by_leaf(rows: np.ndarray, nodes: np.ndarray) -> None:
        if not len(rows):
            return
        by_leaf = np.argsort(nodes, kind="stable")
        met, begin = np.unique(nodes[by_leaf], return_index=True)
        for at, part in zip(met.tolist(), np.split(rows[by_leaf], begin[1:]), strict=True):
            look(part, at)

    def in_order() -> tuple[np.ndarray, np.ndarray]:
        ascending = np.argsort(squares, axis=1, kind="stable")
        return np.sqrt(np.take_along_axis(squares, ascending, axis=1)), np.take_along_axis(counts, ascending, axis=1)

    first = _place(queries, dims, cuts, levels)
    look_by_leaf(np.arange(len(queries)), first)
    bound = _kth(*in_order(), k)
    if reach is not None:
        bound = np.minimum(bound, reach)
    step = max(1, 4 * BLOCK >> levels)
    for start in range(0, len(queries) if levels else 0, step):
        rows, nodes = _reached(queries[start : start + step], bound[start : start + step], low, high, levels)
        other = nodes != first[start + rows]
        look_by_leaf(start + rows[other], nodes[other])
    return in_order()


def _kth(distances: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Distance at which ``k`` copies are covered; infinite if there are fewer."""
    covered = np.cumsum(copies, axis=1) >= k
    return np.where(covered.any(axis=1), distances[np.arange(len(distances)), covered.argmax(axis=1)], math.inf)


class _Cells(NamedTuple):
    """Distinct points dealt to the cells of a tree, each with its ``reach``: the distance to the k-th in its own cell."""

    bounded: DataFrame
    names: list[str]
    fields: str
    tasks: int
    levels: int
    own: int


def _scored_rows(loans: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """Key and features of the rows with a value in every feature, written once: points and scores both read them."""
    return cut_lineage(loans.select(col(key), *[col(c).cast("double").alias(c) for c in features]).na.drop(subset=list(features)))


def _points(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Distinct points as ``x0, x1, ...`` with their number of ``copies``."""
    values = [col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    names = [f"x{i}" for i in range(len(features))]
    return cut_lineage(df.select(*values).groupBy(*names).agg(F.count(F.lit(1)).alias("copies")))


def _in_cells(points: DataFrame, k: int, include_self: bool, turn: np.ndarray | None = None) -> _Cells:
    """Split the points, turned by a matrix if one is given, and search each cell by itself.

    With a column ``sought`` only its points are looked for, among all, and come back.
    """
    names = [n for n in points.columns if n not in ("copies", "sought")]
    some = "sought" in points.columns
    fields = ", ".join(f"{n} double" for n in names)
    total = points.count()
    levels = max(1, math.ceil(math.log2(max(1.0, total / CELL_POINTS))))
    share = max(SAMPLE_FLOOR, SAMPLE_PER_CELL * 2**levels) / max(1, total)
    picked = points.filter(unit_hash(*[F.col(n) for n in names]) < share)
    sample = picked.select(*names).toPandas().to_numpy(dtype=float)
    dims, cuts = _splits(sample if turn is None else sample @ turn, levels)
    shared_splits = points.sparkSession.sparkContext.broadcast((dims, cuts, levels))

    @F.pandas_udf("int")
    def cell_of(batch: pd.DataFrame) -> pd.Series:
        values = batch.to_numpy(dtype=float)
        return pd.Series(_place(values if turn is None else values @ turn, *shared_splits.value).astype(np.int32))

    own = 0 if include_self else -1

    def inside_cell(pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf[names].to_numpy(dtype=float)
        asked = pdf[pdf["sought"]] if some else pdf
        found = _nearest(asked[names].to_numpy(dtype=float), values, pdf["copies"].to_numpy(), k, own)
        return asked[[*names, "copies", "cell"]].assign(reach=_kth(*found, k))

    tasks = 2**levels
    bounded = (
        points.withColumn("cell", cell_of(F.struct(*names)))
        .repartition(tasks, "cell")
        .groupBy("cell")
        .applyInPandas(inside_cell, f"{fields}, copies bigint, cell int, reach double")
    )
    return _Cells(cut_lineage(bounded), names, fields, tasks, levels, own)


def kth_distance(
    df: DataFrame, features: Sequence[str], k: int = NEIGHBORS, include_self: bool = False
) -> DataFrame:
    """Distinct points of ``df`` with ``knn_distance``, unscaled Euclidean.

    A row is not its own neighbour unless ``include_self``; equal rows are
    neighbours at distance zero. Null where there are fewer than ``k`` neighbours.
    """
    cells = _in_cells(_points(df, features), k, include_self)
    merged = _search_other_cells(cells, cells.bounded, k)
    distance = F.when(F.col("reach") < math.inf, F.col("reach"))
    return merged.select(
        *[F.col(n).alias(c) for c, n in zip(features, cells.names, strict=True)],
        distance.alias("knn_distance"),
    )


def bounded_distance(
    df: DataFrame,
    features: Sequence[str],
    k: int = NEIGHBORS,
    include_self: bool = False,
    tables: int = TABLES,
    contamination: float | None = None,
) -> tuple[DataFrame, _Cells]:
    """Distinct points (``x0, ..., copies, reach, cell``) with an upper bound of their k-th distance, at a cost in proportion to their number.

    Each of ``tables`` trees splits space along other random directions into buckets of about
    CELL_POINTS points, and a point looks for neighbours in its own buckets only. The least
    bound counts; infinite where all buckets hold fewer than ``k`` neighbours. The cell is that of
    the first tree, which comes back too. With ``contamination`` trees after the first look only for
    the points that the first bounds highest, LOOKED_AGAIN times the outliers; the others keep that bound.
    """
    points, rng = _points(df, features), np.random.default_rng(11)
    first = _in_cells(points, k, include_self)
    kept = [*first.names, "copies", "reach"]
    found = first.bounded.select(*kept, "cell")
    if contamination is not None and tables > 1:
        distinct, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
        high = F.least("reach", F.lit(sys.float_info.max))
        share = min(1.0, LOOKED_AGAIN * (total * contamination + 1) / max(1, distinct))
        least = exact_quantiles(found.select(high.alias("reach")), ["reach"], [1 - share])["reach"][0]
        points = found.select(*first.names, "copies", (high >= F.lit(least)).alias("sought"))
    for _ in range(tables - 1):
        turn = np.linalg.qr(rng.normal(size=(len(features), len(features))))[0]
        found = found.unionAll(_in_cells(points, k, include_self, turn).bounded.select(*kept, F.lit(None).cast("int").alias("cell")))
    return cut_lineage(found.groupBy(*first.names, "copies").agg(F.min("reach").alias("reach"), F.max("cell").alias("cell"))), first


def pruned_knn_outliers(
    loans: DataFrame,
    features: Sequence[str] = FEATURES,
    key: str = INDEX_COLUMN,
    k: int = NEIGHBORS,
    contamination: float = CONTAMINATION,
    include_self: bool = False,
    tables: int = TABLES,
    refine: bool = True,
) -> DataFrame:
    """``knn_outliers`` for very large tables: key, features, ``knn_distance``, ``exact`` and ``outlier``.

    Bounds from random buckets (``bounded_distance``) rule out most rows: only points whose
    bound is among the largest are searched exactly. A point's distance is at most its
    bound, so once the threshold found among these is not below the largest bound left
    out, it is the threshold of all rows and the flags are those of ``knn_outliers``; until
    then more points are searched. Rows not searched keep their bound as distance, with
    ``exact`` false. With ``refine=False`` bounds stand for distances throughout and the
    flags are approximate. Rows with fewer than ``k`` neighbours have no distance, as there.
    """
    rows = _scored_rows(loans, features, key)
    bounds, cells = bounded_distance(rows, features, k, include_self, tables, contamination)
    distinct, total = bounds.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    wanted = int(total * contamination) + 2
    points = bounds.withColumn("exact", F.lit(False))
    more = 2 * wanted
    while refine and total:
        finite = bounds.select(F.least("reach", F.lit(sys.float_info.max)).alias("reach"))
        least = exact_quantiles(finite, ["reach"], [max(0.0, 1 - more / distinct)])["reach"][0]
        chosen = F.col("reach") >= F.lit(least)
        searched = _search_other_cells(cells, cut_lineage(bounds.filter(chosen)), k)
        known = searched.select(*cells.names, F.col("reach").alias("found"))
        points = cut_lineage(
            bounds.join(known, cells.names, "left").select(
                *cells.names, "copies", F.least("reach", "found").alias("reach"), F.col("found").isNotNull().alias("exact")
            )
        )
        left_out = points.filter("not exact").agg(F.max("reach")).first()[0]
        # so many rows at or beyond the largest bound left out settle the threshold
        settled = points.filter("exact").filter(F.col("reach") >= F.lit(left_out if left_out is not None else 0.0))
        if left_out is None or (settled.agg(F.sum("copies")).first()[0] or 0) >= wanted or more >= distinct:
            break
        more *= 4
    named = points.select(
        *[F.col(n).alias(c) for c, n in zip(features, cells.names, strict=True)],
        F.when(F.col("reach") < math.inf, F.col("reach")).alias("knn_distance"),
        "exact",
    )
    scored = cut_lineage(rows.join(named, list(features)))
    limit = exact_quantiles(scored, ["knn_distance"], [1 - contamination])["knn_distance"][0]
    return scored.withColumn("outlier", F.coalesce(F.col("knn_distance") > F.lit(limit), F.lit(False)))


def _tree_boxes(cells: np.ndarray, least: np.ndarray, greatest: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest corner of every node of the tree; those of empty cells are never met."""
    low = np.full((2 ** (levels + 1), least.shape[1]), math.inf)
    high = -low
    low[cells], high[cells] = least, greatest
    for node in range(levels - 1, -1, -1):
        own, below = slice(2**node, 2 ** (node + 1)), slice(2 ** (node + 1), 2 ** (node + 2))
        low[own] = np.minimum(low[below][0::2], low[below][1::2])
        high[own] = np.maximum(high[below][0::2], high[below][1::2])
    return low, high


def _reached(
    values: np.ndarray, reach: np.ndarray, low: np.ndarray, high: np.ndarray, levels: int
) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the cells whose boxes lie closer to them than their reach.

    All rows walk down the tree together, and a branch ends at a box out of reach.
    """
    rows, nodes = np.arange(len(values)), np.ones(len(values), dtype=int)
    for _ in range(levels):
        rows, nodes = np.repeat(rows, 2), np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel()
        x = values[rows]
        gap = np.maximum(np.maximum(low[nodes] - x, x - high[nodes]), 0)
        # the margin is for rounding of roots
        meets = (gap * gap).sum(axis=1) < reach[rows] ** 2 * (1 + 1e-12)
        rows, nodes = rows[meets], nodes[meets]
    return rows, nodes


def _search_other_cells(cells: _Cells, asked: DataFrame, k: int) -> DataFrame:
    """The points asked for (names, ``reach``, ``cell``), their reach brought down by all cells it meets."""
    names, fields, tasks, levels, own = cells.names, cells.fields, cells.tasks, cells.levels, cells.own
    placed = cells.bounded.select(*names, "copies", "cell")
    boxes = placed.groupBy("cell").agg(
        *[F.min(n).alias(f"lo_{n}") for n in names], *[F.max(n).alias(f"hi_{n}") for n in names]
    )
    found = boxes.toPandas()
    corners = [found[[f"{side}_{n}" for n in names]].to_numpy(dtype=float) for side in ("lo", "hi")]
    shared = placed.sparkSession.sparkContext.broadcast(_tree_boxes(found["cell"].to_numpy(dtype=int), *corners, levels))

    def visits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = shared.value
        for batch in batches:
            for start in range(0, len(batch), VISITORS):
                part = batch.iloc[start : start + VISITORS]
                rows, met = _reached(part[names].to_numpy(dtype=float), part["reach"].to_numpy(), low, high, levels)
                # a reach that stays within the own cell is final
                leaves = np.zeros(len(part), dtype=bool)
                leaves[rows[met != part["cell"].to_numpy()[rows]]] = True
                rows, met = rows[leaves[rows]], met[leaves[rows]]
                yield part.iloc[rows][names + ["reach"]].assign(cell=met)

    queries = cut_lineage(
        asked.select(*names, "reach", "cell").mapInPandas(
            visits, f"{fields}, reach double, cell int"
        )
    )
    # A cell many points visit is searched in several tasks, each with a copy of it.
    shares = queries.groupBy("cell").agg(
        (F.floor(F.count(F.lit(1)) / QUERIES_PER_TASK) + 1).cast("int").alias("tasks")
    )
    shares = cut_lineage(shares)  # one row per cell

    def with_shares(df: DataFrame, tasks_col: str) -> DataFrame:
        side = shares.select(F.col("cell").alias("_cell"), F.col("tasks").alias(tasks_col))
        return df.join(side, F.col("cell") == F.col("_cell")).drop("_cell")

    spread = with_shares(queries, "_asked").withColumn(
        "task", F.pmod(F.xxhash64(*names), F.col("_asked")).cast("int")
    ).drop("_asked")
    copies = with_shares(placed, "_held").withColumn(
        "task", F.explode(F.sequence(F.lit(0), F.col("_held") - 1))
    ).drop("_held")

    def search(visitors: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        values, points = visitors[names].to_numpy(dtype=float), held[names].to_numpy(dtype=float)
        reach = visitors["reach"].to_numpy()
        if not len(values) or not len(points):
            return pd.DataFrame(columns=[*names, "distance", "copies_near"])
        distances, near = _nearest(values, points, held["copies"].to_numpy(), k, own, reach)
        last = (distances < reach[:, None]).sum(axis=1)
        closer = np.flatnonzero(last)
        return visitors[names].iloc[closer].assign(
            distance=[distances[i, : last[i]] for i in closer], copies_near=[near[i, : last[i]] for i in closer]
        )

    extra = (
        spread.repartition(tasks, "cell", "task")
        .groupBy("cell", "task")
        .cogroup(copies.repartition(tasks, "cell", "task").groupBy("cell", "task"))
        .applyInPandas(search, f"{fields}, {NEAREST}")
    )
    # Of all cells' candidates a point keeps its nearest, cut per task before the shuffle; one may be itself.
    each = extra.select(*names, F.inline(F.arrays_zip("distance", "copies_near")))
    nearest = W.partitionBy(*names).orderBy("distance")
    few = each.withColumn("_rank", F.row_number().over(nearest)).filter(F.col("_rank") <= k + 1)
    seen = few.withColumn("_seen", F.sum("copies_near").over(nearest.rowsBetween(W.unboundedPreceding, 0)))
    better = seen.filter(F.col("_seen") >= k).select(*names, F.col("distance").alias("reach"))
    return asked.select(*names, "reach").unionByName(better).groupBy(*names).agg(F.min("reach").alias("reach"))


def knn_outliers(
    loans: DataFrame,
    features: Sequence[str] = FEATURES,
    key: str = INDEX_COLUMN,
    k: int = NEIGHBORS,
    contamination: float = CONTAMINATION,
    include_self: bool = False,
) -> DataFrame:
    """Key, features, ``knn_distance`` and ``outlier``: beyond the score threshold.

    The threshold is the exact ``1 - contamination`` quantile over all loans.
    """
    rows = _scored_rows(loans, features, key)
    distances = kth_distance(rows, features, k, include_self)
    scored = cut_lineage(rows.join(distances, list(features)))
    limit = exact_quantiles(scored, ["knn_distance"], [1 - contamination])["knn_distance"][0]
    return scored.withColumn(
        "outlier", F.coalesce(F.col("knn_distance") > F.lit(limit), F.lit(False))
    )
