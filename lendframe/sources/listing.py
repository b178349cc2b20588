"""File listings as DataFrames and the decisions taken on them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import codes

LISTING = "path string, modificationTime timestamp, length bigint"


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, time and size of the files in a folder; their content is not read."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    except Exception as error:  # a folder that does not exist holds no files
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LISTING)
    return files.select("path", "modificationTime", "length")


def archives_for_years(listing: DataFrame, first: int, last: int) -> DataFrame:
    """Archives whose name holds a year of the range, with the first such year."""
    name = codes.base_name(F.col("path"))
    years = F.filter(
        F.sequence(F.lit(first), F.lit(last)), lambda y: F.contains(name, y.cast("string"))
    )
    return (
        listing.filter(F.endswith(F.lower(name), F.lit(".zip")))
        .withColumn("year", F.array_min(years))
        .filter("year IS NOT NULL")
    )


def pre2007_archives(listing: DataFrame, dataset: str, first: int, last: int) -> DataFrame:
    """One row per wanted year: loans have an archive per year, the others share one."""
    name = codes.base_name(F.col("path"))
    years = listing.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    if dataset == "loans":
        early = F.col("year").between(1981, 1989)
        wanted = F.when(early, "HMDA_LAR_1981_1989.zip").otherwise(
            F.concat(F.lit("HMDA_LAR_"), F.col("year").cast("string"), F.lit(".zip"))
        )
    else:
        wanted = F.lit({"panel": "HMDA_PANEL.zip", "transmissal_series": "HMDA_TS.zip"}[dataset])
    named = years.select("year", wanted.alias("wanted"))
    return listing.join(named, name == F.col("wanted")).drop("wanted")


def route_files(listing: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Raw folder for each file name."""
    return listing.withColumn("dataset", codes.raw_folder(F.col(name_col)))


def transfer_plan(
    remote: DataFrame, local: DataFrame, mode: str = "skip", name_col: str = "file_name"
) -> DataFrame:
    """Which remote files to fetch: name, ``need_transfer``.

    ``skip`` fetches absent files only, ``always`` all, ``if_newer`` and
    ``if_size_diff`` also those whose time (UTC) or size differs. An unknown
    remote time or size never triggers a transfer.
    """
    if mode not in ("skip", "always", "if_newer", "if_size_diff"):
        raise ValueError(f"unknown mode: {mode}")
    here = local.select(
        F.col(name_col).alias("_name"), F.col("size").alias("_size"), F.col("modified").alias("_modified")
    )
    absent = F.col("_name").isNull()
    changed = {
        "skip": F.lit(False),
        "always": F.lit(True),
        "if_newer": F.col("modified") > F.col("_modified"),
        "if_size_diff": F.col("size") != F.col("_size"),
    }[mode]
    return remote.join(here, F.col(name_col) == F.col("_name"), "left").select(
        name_col, (absent | F.coalesce(changed, F.lit(False))).alias("need_transfer")
    )


def sources_of_years(first: int, last: int) -> Column:
    """Whether the source's name holds a year of the range."""
    return reduce(or_, [F.contains(F.col("source"), F.lit(str(y))) for y in range(first, last + 1)])


def pending_sources(
    listing: DataFrame, written: DataFrame, replace: bool = False, key: str = "source"
) -> DataFrame:
    """Sources still to be processed: all of them, or those not written yet."""
    if replace:
        return listing
    return listing.join(written.select(key).distinct(), key, "left_anti")


def year_coverage(listing: DataFrame, first: int, last: int, pattern: str) -> DataFrame:
    """One row per year of the range: the first file by name that holds it, or null."""
    years = listing.sparkSession.range(first, last + 1).toDF("year")
    name = codes.base_name(F.col("path"))
    hits = (
        listing.filter(name.rlike(pattern))
        .withColumn("_year", F.explode(F.sequence(F.lit(first), F.lit(last))))
        .filter(F.contains(name, F.col("_year").cast("string")))
        .groupBy(F.col("_year").cast("bigint").alias("_year"))
        .agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("files"))
    )
    return years.join(hits, F.col("year") == F.col("_year"), "left").select(
        "year", "path", F.coalesce("files", F.lit(0)).alias("files")
    )


def year_paths(listing: DataFrame, first: int, last: int, pattern: str) -> list[str]:
    """One path per year; a year without a file is an error."""
    rows = year_coverage(listing, first, last, pattern).orderBy("year").collect()
    absent = [r["year"] for r in rows if r["path"] is None]
    if absent:
        raise FileNotFoundError(f"no file for {absent}")
    return [r["path"] for r in rows]
