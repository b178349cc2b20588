"""Connected components of links, as joins and grouped minima over written tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lendframe.llm.arrow import column
from lendframe.session import cut_lineage

#: Links a task holds at once while it thins out what it has.
HELD = 1 << 20


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the links given, each node with the smallest node it reaches, but for that node itself."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        before = root.copy()
        np.minimum.at(root, root[left], low)
        np.minimum.at(root, root[right], low)
        while (jumped := root[root]).tolist() != root.tolist():
            root = jumped
        if (root == before).all():
            break
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        a, b = spanning(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        held.append((column(batch, "a").to_numpy(), column(batch, "b").to_numpy()))
        size += batch.num_rows
        if size >= HELD:
            yield flush()
            held, size = [], 0
    if size:
        yield flush()


def connect(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of every node of ``links`` (``a, b`` long).

    Each task first thins its links to a spanning forest. Then, round by round, every node
    points to its smallest neighbour, pointers are followed to their ends, and links are
    redrawn between the ends, until none is left. Minima are taken per task before the
    shuffle, and joins have written tables on both sides, so a hub can be split.
    """
    spark = links.sparkSession
    links = cut_lineage(links.select("a", "b").filter("a != b").mapInArrow(_thin, "a long, b long").distinct())
    mapping: DataFrame | None = None
    while not links.isEmpty():
        ends = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lead = ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select("node", F.least("node", "low").alias("component"))
        lead = cut_lineage(lead)
        while True:
            ahead = lead.select(F.col("node").alias("component"), F.col("component").alias("next"))
            jumped = cut_lineage(lead.join(ahead, "component").select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("moved")))
            lead = jumped.select("node", "component")
            if jumped.filter("moved").isEmpty():
                break
        if mapping is None:
            mapping = lead
        else:
            further = lead.select(F.col("node").alias("component"), F.col("component").alias("next"))
            mapping = cut_lineage(mapping.join(further, "component", "left").select("node", F.coalesce("next", "component").alias("component")))
        to_a = lead.select(F.col("node").alias("a"), F.col("component").alias("x"))
        to_b = lead.select(F.col("node").alias("b"), F.col("component").alias("y"))
        links = cut_lineage(links.join(to_a, "a").join(to_b, "b").filter("x != y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
    return mapping if mapping is not None else spark.createDataFrame([], "node long, component long")
