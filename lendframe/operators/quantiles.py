"""Exact interpolated quantiles without holding a column in one task."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.casts import col
from ..session import cut_lineage

PIECES = 1000
ACCURACY = 10_000
#: Rows of samples that cuts are chosen from, by the driver and by one task. They steer
#: the search, never the result.
LOOKED_AT = 100_000
SAMPLE_ROWS = 1_000_000


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each numeric column, nulls and NaN left out.

    All columns go together. A round chooses cuts from a bounded sample, counts rows
    equal to a cut and rows strictly between cuts, and keeps the slices that hold a
    wanted rank, a small share of all values. So the input is read three times (sample,
    count, kept slices) however many columns there are; later rounds read what was kept.
    The ends of each kept slice are cuts of the next round, hence slices always shrink.
    Infinite values rank like others but are never cuts.
    """
    names = list(dict.fromkeys(columns))
    short = {c: f"v{i}" for i, c in enumerate(names)}
    rest = df.select(*[F.nanvl(col(c).cast("double"), F.lit(None)).alias(v) for c, v in short.items()])
    ranks: dict[str, dict[int, int]] = {}
    totals: dict[str, int] = {}
    found: dict[str, dict[int, float]] = {v: {} for v in short.values()}
    ends: dict[str, set[float]] = {v: set() for v in short.values()}
    todo = list(short.values())
    while todo:
        cuts = _cuts(rest, todo, ends)
        groups = _count_between(rest, todo, cuts)
        kept: dict[str, list[tuple[float, float]]] = {}
        for v in todo:
            if v not in totals:
                totals[v] = sum(n for n, _, _ in groups[v])
                ranks[v] = {r: r for r in _wanted_ranks(totals[v], probs)}
            kept[v], ranks[v] = _narrow(groups[v], ranks[v], found[v])
            ends[v] = {x for span in kept[v] for x in span if math.isfinite(x)}
        todo = [v for v in todo if kept[v]]
        if todo:
            slices = [F.when(_inside(F.col(v), kept[v]), F.col(v)).alias(v) for v in todo]
            rest = cut_lineage(rest.select(*slices).na.drop("all"))
    return {c: _interpolated(totals[v], found[v], probs) for c, v in short.items()}


def approximate_cuts(values: DataFrame, pieces: int, total: int) -> list[float]:
    """Distinct approximate quantiles of column ``v``, from a bounded sample.

    A sketch of every row would send one full sketch per task to a single reducer.
    Cuts only steer the search, so what is computed with them stays exact.
    """
    share = SAMPLE_ROWS / max(1, total)
    looked_at = values if share >= 1 else values.sample(share, seed=7)
    probs = [i / pieces for i in range(pieces + 1)]
    found = looked_at.agg(F.percentile_approx("v", probs, ACCURACY).alias("q")).first()["q"]
    return sorted(set(found or []))


def _wanted_ranks(total: int, probs: Iterable[float]) -> set[int]:
    places = [p * (total - 1) for p in probs] if total else []
    return {math.floor(x) for x in places} | {math.ceil(x) for x in places}


def _cuts(rest: DataFrame, todo: list[str], ends: dict[str, set[float]]) -> dict[str, list[float]]:
    """Finite cuts of every column: approximate quantiles of a sample, and the known ends."""
    share = LOOKED_AT / max(1, rest.count())
    looked_at = (rest if share >= 1 else rest.sample(share, seed=7)).select(*todo).toArrow()
    cuts = {}
    for v in todo:
        values = looked_at[v].drop_null().to_numpy()
        values = np.sort(values[np.isfinite(values)])
        places = np.linspace(0, len(values) - 1, PIECES + 1).astype(int) if len(values) else []
        # adding zero turns the negative zero into the positive one
        cuts[v] = sorted({x + 0.0 for x in values[places].tolist()} | ends[v])
    return cuts


def _count_between(
    rest: DataFrame, todo: list[str], cuts: dict[str, list[float]]
) -> dict[str, list[tuple[int, float, float]]]:
    """Per column, in order: number, least and greatest of the values at a cut or between two."""
    edges = [[-math.inf, *(cuts[v] or [0.0]), math.inf] for v in todo]
    slices = [f"_slice_{v}" for v in todo]
    placed = Bucketizer(
        splitsArray=edges, inputCols=todo, outputCols=slices, handleInvalid="keep"
    ).transform(rest)
    columns = []
    for v, name, bounds in zip(todo, slices, edges, strict=True):
        # one literal, cut into numbers once, instead of a thousand
        lower = F.split(F.lit(",".join(str(x) if math.isfinite(x) else "-Infinity" for x in bounds[:-1])), ",")
        at = F.get(lower.cast("array<double>"), F.col(name).cast("int"))
        part = F.when(F.col(v) == math.inf, 2).when(F.col(v) == at, 0).otherwise(1)
        columns.append(F.struct(F.lit(v).alias("c"), F.col(v).alias("v"), F.col(name).alias("slice"), part.alias("part")))
    counts = (
        placed.select(F.inline(F.array(*columns)))
        .filter("v IS NOT NULL")
        .groupBy("c", "slice", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()
    )
    out: dict[str, list[tuple[int, float, float]]] = {v: [] for v in todo}
    for r in sorted(counts, key=lambda r: (r["slice"], r["part"])):
        out[r["c"]].append((r["n"], r["lo"], r["hi"]))
    return out


def _narrow(
    groups: list[tuple[int, float, float]], ranks: dict[int, int], found: dict[int, float]
) -> tuple[list[tuple[float, float]], dict[int, int]]:
    """Spans that hold ranks still open, and these ranks counted within the spans alone.

    ``ranks`` maps a rank among the values at hand to the rank asked for. Ranks in a
    group of one value are found.
    """
    spans: list[tuple[float, float]] = []
    left: dict[int, int] = {}
    start = held = 0
    waiting = sorted(ranks)
    for n, lo, hi in groups:
        inside = [r for r in waiting if r < start + n]
        waiting = waiting[len(inside) :]
        if inside and lo == hi:
            found.update({ranks[r]: lo for r in inside})
        elif inside:
            spans.append((lo, hi))
            left.update({r - start + held: ranks[r] for r in inside})
            held += n
        start += n
    return spans, left


def _inside(value: Column, spans: list[tuple[float, float]]) -> Column:
    test = F.lit(False)
    for lo, hi in spans:
        test = test | value.between(lo, hi)
    return test


def _interpolated(
    total: int, found: dict[int, float], probs: Sequence[float]
) -> list[float | None]:
    if total == 0:
        return [None] * len(probs)
    out = []
    for x in (p * (total - 1) for p in probs):
        low, high = found[math.floor(x)], found[math.ceil(x)]
        share = x - math.floor(x)
        out.append(low if low == high or share == 0 else low + (high - low) * share)
    return out
