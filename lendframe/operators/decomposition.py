"""Decomposition of a mean gap between two groups over several covariates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..functions.casts import col

#: Combinations of group and category levels that a decomposition may have.
MAX_CELLS = 10_000
#: A term whose spread is this much smaller once the others are known adds nothing to them.
DEPENDENT = 1e-9


def _cells(data: DataFrame, outcome: str, numeric: Sequence[str], categories: Sequence[str]) -> list:
    """Per group and combination of levels: rows, means and covariances. One pass."""
    names = [outcome, *numeric]
    moments = [F.covar_pop(col(a), col(b)).alias(f"cov_{i}_{j}") for i, a in enumerate(names) for j, b in enumerate(names) if i <= j]
    means = [F.avg(col(c)).alias(f"mean_{i}") for i, c in enumerate(names)]
    cells = data.groupBy("_group", *[col(c) for c in categories]).agg(F.count(F.lit(1)).alias("_rows"), *means, *moments)
    found = cells.limit(MAX_CELLS + 1).collect()
    if len(found) > MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS} combinations of categories")
    return found


def _moments(cells: list, terms: list[tuple[str, object]], size: int, categories: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of outcome, numeric covariates and category terms, put together from the cells."""
    weight = np.array([c["_rows"] for c in cells], float)
    values = np.array([[*(c[f"mean_{i}"] for i in range(size)), *(float(c[name] == level) for name, level in terms)] for c in cells])
    mean = weight @ values / weight.sum()
    spread = (values - mean).T * weight @ (values - mean)
    for i in range(size):
        for j in range(size):
            spread[i, j] += sum(c["_rows"] * c[f"cov_{min(i, j)}_{max(i, j)}"] for c in cells)
    return mean, spread / weight.sum()


def _check_rank(spread: np.ndarray, names: Sequence[str]) -> None:
    """Every covariate must keep some spread of its own once those before it are known."""
    left = spread.copy()
    for k, name in enumerate(names):
        if left[k, k] <= DEPENDENT * max(spread[k, k], np.finfo(float).tiny):
            raise ValueError(f"{name} is fixed by the covariates before it")
        left = left - np.outer(left[:, k], left[k]) / left[k, k]


def rate_decomposition(
    loans: DataFrame,
    group_col: str,
    groups: tuple[object, object],
    outcome: str,
    numeric: Sequence[str] = (),
    categories: Sequence[str] = (),
) -> DataFrame:
    """``covariate, contribution, share`` of the gap between two groups' mean outcomes.

    A covariate's contribution is what the groups' different means of it predict at the second
    group's least-squares coefficients; that of a category adds up over its levels, the
    lowest of which is the base. ``(unexplained)`` is the rest of ``(gap)``. Rows with a null in
    any column named are left out. Shares are of the gap; null if there is none.

    One pass gathers counts, means and covariances per group and combination of levels; only
    these, at most MAX_CELLS rows, are solved on the driver. Covariates that others fix, in
    the second group, are an error, as is a group without rows.
    """
    wanted = [outcome, *numeric]
    data = loans.filter(col(group_col).isin(*groups)).select(
        col(group_col).alias("_group"), *[col(c).cast("double").alias(c) for c in wanted], *[col(c).cast("string").alias(c) for c in categories]
    )
    whole = reduce(lambda a, b: a & b, [col(c).isNotNull() & ~F.isnan(col(c)) for c in wanted] + [col(c).isNotNull() for c in categories])
    cells = _cells(data.filter(whole), outcome, numeric, categories)
    parts = [[c for c in cells if c["_group"] == g] for g in groups]
    if not all(parts):
        raise ValueError(f"no rows of one of {groups}")
    terms = [(name, level) for name in categories for level in sorted({c[name] for c in parts[1]})[1:]]
    # a level that only the first group has takes part in its means, at no coefficient
    size = len(wanted)
    (mean_a, _), (mean_b, spread) = (_moments(p, terms, size, categories) for p in parts)
    names = [*numeric, *(f"{name} = {level}" for name, level in terms)]
    _check_rank(spread[1:, 1:], names)
    scale = np.sqrt(np.diag(spread)[1:])
    slopes = np.linalg.solve(spread[1:, 1:] / np.outer(scale, scale), spread[1:, 0] / scale) / scale if names else np.zeros(0)
    moves = slopes * (mean_a[1:] - mean_b[1:])
    gap = float(mean_a[0] - mean_b[0])
    rows: dict[str, float] = dict.fromkeys([*numeric, *categories], 0.0)
    for k, move in enumerate(moves.tolist()):
        rows[numeric[k] if k < len(numeric) else terms[k - len(numeric)][0]] += move
    rows |= {"(gap)": gap, "(unexplained)": gap - float(moves.sum())}
    table = [(name, value, value / gap if gap else None) for name, value in rows.items()]
    return loans.sparkSession.createDataFrame(table, "covariate string, contribution double, share double")
