"""Lender-level reporting patterns: exemptions and averages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..eras import EXEMPT_CODES, EXEMPTION_COLUMNS, INDEX_COLUMN
from ..functions.casts import col, number
from ..session import cut_lineage

# Average exemptions per loan that mark a partly exempt reporter.
MIN_AVERAGE = 1
BELOW_AVERAGE = 26
LENDER_YEAR = ("lei", "activity_year")


def exemption_count(df: DataFrame, columns: Sequence[str] = EXEMPTION_COLUMNS) -> Column:
    """Number of a row's columns that hold an exemption code."""
    flags = [
        F.when(col(c).cast("string").isin(*EXEMPT_CODES), 1).otherwise(0)
        for c in columns
        if c in df.columns
    ]
    return reduce(lambda a, b: a + b, flags, F.lit(0)).cast("bigint")


def exempt_reporters(
    df: DataFrame, columns: Sequence[str] = EXEMPTION_COLUMNS, key: str = INDEX_COLUMN
) -> DataFrame:
    """Loans of lenders that report some fields as exempt but not all.

    The average is taken per lender and year before any row moves, so a lender
    with a large share of all loans needs no task of its own.
    """
    present = [c for c in columns if c in df.columns]
    counted = df.withColumn("CountExemptions", exemption_count(df, present))
    averages = counted.groupBy(*[col(k).alias(f"_{k}") for k in LENDER_YEAR]).agg(
        F.avg("CountExemptions").alias("AverageExemptions")
    )
    average = F.col("AverageExemptions")
    chosen = averages.filter((average >= MIN_AVERAGE) & (average < BELOW_AVERAGE))
    same = reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"_{k}")) for k in LENDER_YEAR])
    return counted.join(cut_lineage(chosen), same).select(
        key, *LENDER_YEAR, *[col(c) for c in present], "CountExemptions", "AverageExemptions"
    )


def lender_averages(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and count per year, lender and measure, all measures in one pass.

    Exemption codes in text columns count as missing.
    """
    kinds = dict(df.dtypes)
    values = {}
    for c in columns:
        value = number(col(c), kinds[c])
        values[c] = F.when(~col(c).eqNullSafe(F.lit("1111")), value) if kinds[c] == "string" else value
    wide = df.groupBy("activity_year", "lei").agg(
        *[F.struct(F.avg(v).alias("average"), F.count(v).alias("n")).alias(c) for c, v in values.items()]
    )
    return (
        wide.unpivot(["activity_year", "lei"], [col(c) for c in columns], "measure", "stats")
        .filter(F.col("stats.n") > 0)
        .select(
            "activity_year",
            "lei",
            "measure",
            F.col("stats.average").alias("average_value"),
            F.col("stats.n").alias("count_observations"),
        )
    )
