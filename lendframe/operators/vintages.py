"""Which release of a year's file to use."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions.casts import col


def best_releases(
    df: DataFrame, year_col: str = "activity_year", type_col: str = "file_type"
) -> DataFrame:
    """Rows of the lowest file type per year, among the rows given.

    Nothing runs until the result is used. The lowest types, one per reporting year, are a
    scalar subquery over the two columns; on a table partitioned by them it is answered
    before the scan and prunes whole folders. No row is shuffled.
    """
    year, kind = (col(c).cast("string") for c in (year_col, type_col))
    key = F.concat(F.lit("y"), F.coalesce(year, F.lit("")))
    pairs = df.groupBy(key.alias("_year")).agg(F.min(kind).alias("_type"))
    lowest = pairs.agg(F.array_sort(F.collect_set(F.concat_ws("=", "_year", "_type"))).alias("_lowest"))
    return df.filter(F.array_contains(lowest.scalar(), F.concat(key, F.lit("="), kind)))


def keep_releases(
    df: DataFrame,
    chosen: Mapping[object, str],
    year_col: str = "activity_year",
    type_col: str = "file_type",
) -> DataFrame:
    """Rows of the given type per year."""
    tests = [
        col(year_col).eqNullSafe(F.lit(year)) & (col(type_col) == F.lit(kind))
        for year, kind in chosen.items()
    ]
    return df.filter(reduce(lambda a, b: a | b, tests, F.lit(False)))


def county_counts(df: DataFrame) -> DataFrame:
    keys = ["activity_year", "state_code", "county_code"]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(*keys)


def best_county_counts(df: DataFrame) -> DataFrame:
    """``county_counts`` of the lowest file type per year, from one pass over ``df``.

    Rows are counted by type as well, and the type is chosen among the counts.
    """
    keys = ["activity_year", "state_code", "county_code"]
    counts = df.groupBy(*keys, "file_type").agg(F.count(F.lit(1)).alias("count"))
    lowest = F.min("file_type").over(W.partitionBy("activity_year"))
    best = counts.withColumn("_lowest", lowest).filter("file_type = _lowest")
    return best.select(*keys, "count").orderBy(*keys)


def release_inventory(df: DataFrame) -> DataFrame:
    """Distinct (year, type) pairs, sorted."""
    return df.select("activity_year", "file_type").distinct().orderBy("activity_year", "file_type")
