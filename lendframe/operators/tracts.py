"""Tract statistics kept once per tract instead of once per loan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..eras import POST2018_TRACT_COLUMNS
from ..functions.casts import col, number


def split_tracts(
    df: DataFrame, columns: Sequence[str] = POST2018_TRACT_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """(loans without tract statistics, distinct tract statistics by year)."""
    kinds = dict(df.dtypes)
    present = [c for c in columns if c in kinds]
    facts = df.drop(*present)
    tracts = df.select(
        "activity_year", "census_tract", *[number(col(c), kinds[c]).alias(c) for c in present]
    ).distinct()
    return facts, tracts
