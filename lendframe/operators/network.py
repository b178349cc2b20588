"""How connected the two sides of a market are: ranks on a bipartite network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import col
from ..session import cut_lineage, written_and_measured

DAMPING = 0.85
TOLERANCE = 1e-4
MAX_ROUNDS = 100


def connection_edges(loans: DataFrame, left: str = "lei", right: str = "county_code", weight: Column | None = None) -> DataFrame:
    """``left, right, weight``: how often (or how much) a lender and a market meet; rows without one of them have no edge."""
    total = F.count(F.lit(1)) if weight is None else F.sum(weight)
    met = loans.filter(col(left).isNotNull() & col(right).isNotNull())
    edges = met.groupBy(col(left).cast("string").alias("left"), col(right).cast("string").alias("right")).agg(total.cast("double").alias("weight"))
    return edges.filter("weight > 0")


def network_rank(
    edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, max_rounds: int = MAX_ROUNDS
) -> DataFrame:
    """``side, node, degree, strength, score`` of every node of a bipartite network (``left, right, weight``).

    A score is where a walk spends its time that crosses an edge with the share ``damping``, by
    weight, and else starts anew anywhere; scores add up to one. Rounds go on until scores
    change by less than ``tolerance`` altogether.

    Each round is one join of the edges with the scores of their ends, summed per node by every
    task before the shuffle, so a node that most edges meet costs no more than others. It is
    written with the change, and the next one reads it; only the change reaches the driver.
    Edges that repeat are added up first. Without edges there are no rows.
    """
    edges = edges.filter("weight > 0 and left is not null and right is not null")
    edges = cut_lineage(edges.groupBy("left", "right").agg(F.sum("weight").alias("weight")))
    ways = edges.selectExpr("'left' as side", "left as node", "right as other", "weight")
    ways = ways.unionAll(edges.selectExpr("'right' as side", "right as node", "left as other", "weight"))
    nodes = ways.groupBy("side", "node").agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength"))
    nodes, size = written_and_measured(nodes, F.count(F.lit(1)))
    # a walk leaves an end by the share of the edge in all of its edges
    ends = nodes.select(F.col("side").alias("_side"), F.col("node").alias("_node"), "strength")
    across = ways.join(ends, (F.col("side") != F.col("_side")) & (F.col("other") == F.col("_node")))
    steps = cut_lineage(across.select("side", "node", "other", (F.col("weight") / F.col("strength")).alias("share")))
    start = F.lit((1 - damping) / size if size else 0.0)
    scores = nodes.select("side", "node", F.lit(1.0 / size if size else 0.0).alias("score"))
    for _ in range(max_rounds if size else 0):
        held = scores.select(F.col("side").alias("_side"), F.col("node").alias("_node"), "score")
        flow = steps.join(held, (F.col("side") != F.col("_side")) & (F.col("other") == F.col("_node")))
        summed = flow.groupBy("side", "node").agg(F.sum(F.col("score") * F.col("share")).alias("into"))
        before = scores.select("side", "node", F.col("score").alias("before"))
        moved = summed.join(before, ["side", "node"]).select("side", "node", (start + damping * F.col("into")).alias("score"), "before")
        moved, change = written_and_measured(moved, F.sum(F.abs(F.col("score") - F.col("before"))))
        scores = moved.select("side", "node", "score")
        if change < tolerance:
            break
    return nodes.join(scores, ["side", "node"]).select("side", "node", "degree", "strength", "score")
