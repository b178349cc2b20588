"""One view over the three eras."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import col

AS_TEXT = ("agency_code", "msa_md")
ALIASES = {"tract_one_to_four_family_units": "tract_one_to_four_family_homes"}


def _aligned(df: DataFrame, era: str) -> DataFrame:
    df = df.withColumnsRenamed(ALIASES)
    return df.select(
        F.lit(era).alias("era"),
        *[col(c).cast("string").alias(c) if c in AS_TEXT else col(c) for c in df.columns],
    )


def all_eras(pre2007: DataFrame, period_2007_2017: DataFrame, post2018: DataFrame) -> DataFrame:
    """Union by name. Agency and metro codes become text; state codes stay as reported."""
    frames = [
        _aligned(pre2007, "pre2007"),
        _aligned(period_2007_2017, "period_2007_2017"),
        _aligned(post2018, "post2018"),
    ]
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first
