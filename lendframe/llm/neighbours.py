"""Near-duplicate vectors by navigable small-world graphs, one per shard.

Vectors of one label (and length) are dealt to shards by a hash of their id. Each shard
builds a hierarchical small-world graph. Every vector queries every shard of its label by
beam search, in its own shard from its own place; while a whole beam lies within the threshold
it is widened. An audit compares a fixed number of queries with all vectors of the shard; while
their mean recall is less than AUDITED, all beams are widened. A query whose beam would hold
more than WIDEST of a shard, and all queries of a shard whose audits fail up to that width, are
compared in full, as are shards of at most SMALL vectors: there a product costs less than a
graph. Pairs found are verified by cosine in double precision, and their components united.

Vectors that are null, of length zero or that hold null or non-finite numbers, and those
without label or id, are linked with nothing. Of rows with one id every distinct label and
vector is compared, and their links are the id's; an id gets one row. Rows without id get a
row each. Tables without rows give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendframe.llm.arrow import column
from lendframe.llm.components import connect, spanning
from lendframe.session import cut_lineage

COSINE = 0.93
#: Vectors of a shard, about.
SHARD = 8192
#: Shards up to this size are compared in full: that costs less than a graph.
SMALL = 512
DEGREE = 16
#: Candidates for the places of a row: its nearest, and rows farther off that chose it.
NEAREST, FARTHER = 48, 16
QUERY_BEAM = 16
BLOCK = 256
#: Nodes a beam opens at once.
OPENED = 4
AUDITS, AUDITED = 256, 0.98
#: Beams of more than this share of a shard cost more than comparing all.
WIDEST = 1 / 16
#: Single precision finds candidates this far below the threshold.
SLACK = 1e-4


class Graph:
    """Layers of a small world over unit vectors; row k of a layer lists the neighbours of k, -1 for none."""

    def __init__(self, units: np.ndarray, layers: list[np.ndarray], entry: int):
        self.units, self.layers, self.entry = units, layers, entry

    @classmethod
    def build(cls, units: np.ndarray, seed: int = 3) -> Graph:
        """Each row meets the rows before it, as in insertion one by one, but with all of a shard's
        products at hand: the nearest earlier rows of its layers are exact, not searched for."""
        n = len(units)
        heights = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int), 4)
        heights[:1] = heights.max(initial=0)
        layers = []
        for level in range(int(heights.max(initial=0)) + 1):
            rows = np.flatnonzero(heights >= level)
            layer = np.full((n, DEGREE * 2 if level == 0 else DEGREE), -1, np.int32)
            layer[rows] = cls._linked(units[rows], rows.astype(np.int32), layer.shape[1])
            layers.append(layer)
        return cls(units, layers, 0)

    @classmethod
    def _linked(cls, units: np.ndarray, rows: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` neighbours of the rows of one layer: those each chose, and those that chose it."""
        n = len(units)
        ahead = np.full((n, DEGREE), -1, np.int64)
        for at in range(0, n, BLOCK):
            own = np.arange(at, min(n, at + BLOCK))
            sims = units[own] @ units[: own[-1] + 1].T
            sims[np.arange(own[-1] + 1) >= own[:, None]] = -2
            few = min(NEAREST, sims.shape[1])
            near = np.argpartition(-sims, few - 1, axis=1)[:, :few]
            ahead[own] = cls._spread(units, near, np.take_along_axis(sims, near, 1), DEGREE)
        a, b = np.repeat(np.arange(n), DEGREE), ahead.ravel()
        a, b = a[b >= 0], b[b >= 0]
        ends, others = np.concatenate([a, b]), np.concatenate([b, a])
        sims = np.concatenate([np.einsum("kd,kd->k", units[a[k : k + 65536]], units[b[k : k + 65536]]) for k in range(0, max(len(a), 1), 65536)])
        order = np.lexsort((-np.concatenate([sims, sims]), ends))
        ends, others, sims = ends[order], others[order], np.concatenate([sims, sims])[order]
        counts = np.bincount(ends, minlength=n)
        place = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
        # of a row that very many chose: the nearest, and some of the others at even steps
        far = place - NEAREST
        step = np.maximum((counts - NEAREST) // FARTHER, 1)[ends]
        spot = np.where(far < 0, place, np.where((far % step == 0) & (far // step < FARTHER), NEAREST + far // step, -1))
        held = spot >= 0
        ids, known = np.full((n, NEAREST + FARTHER), -1, np.int64), np.full((n, NEAREST + FARTHER), -2, np.float32)
        ids[ends[held], spot[held]], known[ends[held], spot[held]] = others[held], sims[held]
        chosen = np.full((n, degree), -1, np.int64)
        for at in range(0, n, BLOCK):
            chosen[at : at + BLOCK] = cls._spread(units, ids[at : at + BLOCK], known[at : at + BLOCK], degree)
        return np.where(chosen >= 0, rows[np.maximum(chosen, 0)], -1)

    @staticmethod
    def _spread(units: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
        """Up to ``degree`` neighbours of each row: nearest first, those that lie nearer to the row
        than to any one taken before; free places go to the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        valid = (ids >= 0) & (sims > -1.5)
        vectors = units[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        n, k = ids.shape
        taken, nearer, size = np.zeros((n, k), bool), np.full((n, k), -2, np.float32), np.zeros(n, np.int64)
        for at in range(k):
            good = valid[:, at] & (nearer[:, at] < sims[:, at]) & (size < degree)
            taken[:, at], size = good, size + good
            np.maximum(nearer, between[:, at], out=nearer, where=good[:, None])
        rank = np.where(taken, 0, np.where(valid, 1, 2)) * k + np.arange(k)
        best = np.argsort(rank, axis=1)[:, :degree]
        found = np.where(np.take_along_axis(valid, best, 1), np.take_along_axis(ids, best, 1), -1)
        return found if found.shape[1] == degree else np.pad(found, ((0, 0), (0, degree - found.shape[1])), constant_values=-1)

    def beam(self, queries: np.ndarray, entries: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest found for each query by best-first search, nearest first."""
        layer, count = self.layers[level], len(queries)
        seen = np.zeros((count, len(self.units)), bool)
        slot = np.zeros((count, len(self.units)), np.int32)
        line = np.arange(count)
        ids = np.full((count, width), -1, np.int64)
        sims = np.full((count, width), -2.0, np.float32)
        opened = np.ones((count, width), bool)
        ids[:, : entries.shape[1]] = entries
        sims[:, : entries.shape[1]] = np.einsum("bkd,bd->bk", self.units[entries], queries)
        opened[:, : entries.shape[1]] = False
        seen[line[:, None], entries] = True
        while True:
            waiting = np.where(opened, -3.0, sims)
            live = np.flatnonzero(waiting.max(axis=1) > -1.5)
            if not len(live):
                return ids, sims
            few = min(OPENED, width)
            pick = np.argpartition(-waiting[live], few - 1, axis=1)[:, :few] if few < width else np.argsort(-waiting[live], axis=1)[:, :few]
            fresh = np.take_along_axis(waiting[live], pick, 1) > -1.5
            nodes = np.where(fresh, np.take_along_axis(ids[live], pick, 1), -1)
            opened[live[:, None], pick] = True
            near = np.where(nodes[:, :, None] >= 0, layer[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
            safe = np.maximum(near, 0)
            new = (near >= 0) & ~seen[live[:, None], safe]
            # of a node met twice in this step, one place counts
            r, c = np.nonzero(new)
            slot[live[r], near[r, c]] = c
            new[r, c] = slot[live[r], near[r, c]] == c
            r, c = np.nonzero(new)
            seen[live[r], near[r, c]] = True
            more = np.full(near.shape, -2.0, np.float32)
            more[r, c] = np.einsum("kd,kd->k", self.units[near[r, c]], queries[live[r]])
            all_sims = np.hstack([sims[live], more])
            top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            top_sims = np.take_along_axis(all_sims, top, 1)
            order = np.argsort(-top_sims, axis=1)
            top = np.take_along_axis(top, order, 1)
            sims[live] = np.take_along_axis(all_sims, top, 1)
            ids[live] = np.take_along_axis(np.hstack([ids[live], np.where(new, near, -1)]), top, 1)
            opened[live] = np.take_along_axis(np.hstack([opened[live], ~new]), top, 1)

    def within(self, queries: np.ndarray, least: float, width: int, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (query, node) found with similarity of at least ``least``, and the queries left open.

        With ``own``, query k is node k and starts there. A beam that lies within the threshold is
        doubled; a query is left open once its beam would hold more than WIDEST of the graph.
        """
        rows, nodes, left = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(queries), BLOCK):
            block = queries[at : at + BLOCK]
            if own:
                entries = np.arange(at, at + len(block))[:, None]
            else:
                entries = np.full((len(block), 1), self.entry)
                for level in range(len(self.layers) - 1, 0, -1):
                    entries = self.beam(block, entries, level, 4)[0][:, :1]
            todo, beam = np.arange(len(block)), width
            while len(todo) and beam <= max(WIDEST * len(self.units), width):
                beam = min(beam, len(self.units))
                ids, sims = self.beam(block[todo], entries[todo], 0, beam)
                full = (sims[:, -1] >= least) & (beam < len(self.units))
                r, c = np.nonzero((sims >= least) & ~full[:, None])
                rows.append(todo[r] + at)
                nodes.append(ids[r, c])
                todo, beam = todo[full], beam * 2
            left.append(todo + at)
        return np.concatenate(rows), np.concatenate(nodes), np.concatenate(left)


def links_between(queries: np.ndarray, graph: Graph, vectors: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Verified links of ``queries`` (double precision) to the vectors of a graph, with audits.

    An audit compares AUDITS queries drawn at random, and as many of those that found links,
    with all vectors; their number doesn't depend on how rare links are.
    """
    units, target = _unit(queries), _unit(vectors)
    everything = np.arange(len(queries))
    if len(vectors) <= SMALL:
        return compared(queries, vectors, units, target, everything, own)
    drawn = np.random.default_rng(7).permutation(len(queries))[:AUDITS]
    single, width = units.astype(np.float32), QUERY_BEAM
    while True:
        row, node, left = graph.within(single, COSINE - SLACK, width, own)
        exact = np.concatenate([cosine(queries[row[k : k + 65536]], vectors[node[k : k + 65536]]) for k in range(0, max(len(row), 1), 65536)])
        good = exact >= COSINE
        if own:
            good &= row != node
        more_row, more_node = compared(queries, vectors, units, target, left, own)
        row, node = np.concatenate([row[good], more_row]), np.concatenate([node[good], more_node])
        found = np.bincount(row, minlength=len(queries))
        linked = np.setdiff1d(np.flatnonzero(found), left)
        audited = np.union1d(drawn, linked[:: max(1, -(-len(linked) // AUDITS))])
        true = np.bincount(compared(queries, vectors, units, target, audited, own)[0], minlength=len(queries))
        if audit(found[audited], true[audited]):
            return row, node
        if width >= WIDEST * len(vectors):
            return compared(queries, vectors, units, target, everything, own)
        width *= 2


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def scaled(values: np.ndarray) -> np.ndarray:
    """Each vector times a power of two that brings its largest component to about one: same cosines, no overflow."""
    _, exponent = np.frexp(np.abs(values).max(axis=1, initial=0))
    return np.ldexp(values, -exponent[:, None])


def audit(found: np.ndarray, true: np.ndarray) -> bool:
    """Whether the mean recall of queries that have links is high enough, both with each query and with each group counting alike."""
    found, true = found[true > 0], true[true > 0]
    recall = np.minimum(found / true, 1)
    return not len(true) or min(recall.mean(), np.average(recall, weights=1 / (true + 1))) >= AUDITED


def compared(queries: np.ndarray, vectors: np.ndarray, units: np.ndarray, target: np.ndarray, chosen: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """All links of the chosen queries, by blocks."""
    rows, nodes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(chosen), BLOCK):
        block = chosen[at : at + BLOCK]
        sims = units[block] @ target.T
        if own:
            sims[np.arange(len(block)), block] = -2
        r, node = np.nonzero(sims >= COSINE - 1e-9)
        row, near = block[r], sims[r, node] < COSINE + 1e-9
        good = ~near
        good[near] = cosine(queries[row[near]], vectors[node[near]]) >= COSINE
        rows.append(row[good])
        nodes.append(node[good])
    return np.concatenate(rows), np.concatenate(nodes)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.einsum("kd,kd->k", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))


def build_shards(vectors: DataFrame) -> DataFrame:
    """One row per shard: ids, vectors and graph as bytes."""

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["vec_id", "tie"], kind="stable")
        values = scaled(np.stack(frame["embedding"].to_numpy()).astype(np.float64))
        graph = Graph.build(_unit(values).astype(np.float32)) if len(values) > SMALL else Graph(values, [], 0)
        row = {
            "label": frame["label"].iloc[0],
            "size": frame["size"].iloc[0],
            "shard": frame["shard"].iloc[0],
            "ids": frame["vec_id"].to_numpy(np.int64).tobytes(),
            "repeats": frame["repeats"].to_numpy(bool).tobytes(),
            "vectors": values.tobytes(),
            "layers": [x.tobytes() for x in graph.layers],
        }
        return pd.DataFrame([row])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.groupBy("label", "size", "shard").applyInPandas(build, f"label {kind}, size int, shard int, ids binary, repeats binary, vectors binary, layers array<binary>")


def _load(row: dict, side: str) -> tuple[np.ndarray, np.ndarray, Graph]:
    ids = np.frombuffer(row[f"{side}_ids"], np.int64)
    values = np.frombuffer(row[f"{side}_vectors"], np.float64).reshape(len(ids), -1)
    units = _unit(values).astype(np.float32)
    layers = [np.frombuffer(x, np.int32).reshape(len(ids), -1) for x in row[f"{side}_layers"]]
    return ids, values, Graph(units, layers, 0)


def search_shards(shards: DataFrame) -> DataFrame:
    """Per pair of shards of a label: ``vec_id, n_links, root`` (least vector reached) of vectors with links there.

    Links of an id that repeats can turn up in several pairs of shards. They are not counted
    in ``n_links``, but get a row each with the ``other`` id.
    """
    sides = [shards.select("label", "size", F.col("shard").alias(f"{s}_shard"), *(F.col(c).alias(f"{s}_{c}") for c in ("ids", "repeats", "vectors", "layers"))) for s in "xy"]
    pairs = sides[0].join(sides[1], ["label", "size"]).filter("x_shard <= y_shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: column(batch, n)[k].as_py() for n in batch.schema.names}
                ids, values, graph = _load(row, "x")
                if row["x_shard"] == row["y_shard"]:
                    a, b = links_between(values, graph, values, True)
                    a, b = ids[a], ids[b]
                else:
                    other_ids, others, other_graph = _load(row, "y")
                    a, b = links_between(values, other_graph, others, False)
                    c, d = links_between(others, graph, values, False)
                    a, b = np.concatenate([ids[a], ids[d]]), np.concatenate([other_ids[b], other_ids[c]])
                a, b = a[a != b], b[a != b]
                if not len(a):
                    continue
                # a link found from either end counts for both
                both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                nodes = np.unique(both)
                repeated = np.concatenate([np.frombuffer(row[f"{s}_ids"], np.int64)[np.frombuffer(row[f"{s}_repeats"], bool)] for s in "xy"])
                apart = np.isin(both, repeated).any(axis=0)
                counts = np.bincount(np.searchsorted(nodes, both[:, ~apart].ravel()), minlength=len(nodes))
                moved, roots = spanning(both[0], both[1])
                root = nodes.copy()
                root[np.searchsorted(nodes, moved)] = roots
                ends = np.hstack([both[:, apart], both[::-1, apart]])
                parts = [(nodes, counts, root, pa.nulls(len(nodes), pa.int64())), (ends[0], 0 * ends[0], ends[0], pa.array(ends[1], pa.int64()))]
                for *numbers, other in parts[: 1 + apart.any()]:
                    yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in numbers), other], ["vec_id", "n_links", "root", "other"])

    dealt = pairs.repartition("label", "size", "x_shard", "y_shard")
    return dealt.mapInArrow(run, "vec_id long, n_links long, root long, other long")


def link_vectors(table: DataFrame, shard: int = SHARD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every id, and of every row without one."""
    if table.schema["vec_id"].dataType.simpleString() not in ("tinyint", "smallint", "int", "bigint"):
        raise TypeError("vec_id must be a whole number: the smallest of a component names it")
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = table.filter("vec_id is not null and label is not null and embedding is not null").filter(finite & F.exists("embedding", lambda v: v != 0))
    usable = cut_lineage(usable.select("vec_id", "label", F.size("embedding").alias("size"), "embedding").distinct())
    counts = usable.groupBy("label", "size").agg(F.ceil(F.count("*") / shard).cast("int").alias("shards"))
    repeated = cut_lineage(usable.groupBy("vec_id").count().filter("count > 1").select("vec_id", F.lit(True).alias("repeats")))
    known = usable.join(cut_lineage(counts), ["label", "size"]).join(repeated, "vec_id", "left").withColumn("repeats", F.coalesce("repeats", F.lit(False)))
    # an id's many vectors are dealt apart
    tied = known.withColumn("tie", F.when(F.col("repeats"), F.xxhash64("embedding")).otherwise(F.lit(0).cast("long")))
    dealt = tied.withColumn("shard", F.expr("cast(pmod(if(repeats, xxhash64(vec_id, tie), xxhash64(vec_id)), shards) as int)"))
    found = cut_lineage(search_shards(cut_lineage(build_shards(dealt.select("vec_id", "label", "size", "shard", "tie", "repeats", "embedding")))))
    per_id = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    per_repeat = found.filter("other is not null").select("vec_id", "other").distinct().groupBy("vec_id").agg(F.count("*").alias("more"))
    sums = cut_lineage(per_id.join(per_repeat, "vec_id", "left").select("vec_id", (F.col("n_links") + F.coalesce("more", F.lit(0))).alias("n_links")))
    components = connect(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")).filter("a != b"))
    components = components.select(F.col("node").alias("vec_id"), F.col("component").alias("component_id"))
    ids = table.select("vec_id")
    rows = ids.filter("vec_id is not null").distinct().unionAll(ids.filter("vec_id is null"))
    joined = rows.join(sums, "vec_id", "left").join(components, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
