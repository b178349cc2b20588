"""Combined lender files per era."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ..eras import LENDER_KEYS_2007_2017, LENDER_KEYS_POST2018
from ..operators.columns import concat_diagonal
from ..operators.lenders import (
    lenders_2007_2017,
    lenders_post2018,
    tidy_panel_2007_2017,
    tidy_ts_2007_2017,
    validate_lenders,
)
from ..sources.layers import write_lenders
from ..sources.listing import list_files, year_paths

# File name patterns of the yearly files.
PARQUET = r"\.parquet$"
CSV = r"\.csv$"


def _parquet_years(spark: SparkSession, folder: str, first: int, last: int) -> DataFrame:
    """One Parquet file per year; types may differ between years, columns are unioned."""
    paths = year_paths(list_files(spark, folder), first, last, PARQUET)
    return concat_diagonal([spark.read.parquet(p) for p in paths])


def _csv_years(spark: SparkSession, folder: str, first: int, last: int, tidy) -> DataFrame:
    """One text file per year; headers differ, so each is read on its own and unioned."""
    paths = year_paths(list_files(spark, folder), first, last, CSV)
    return concat_diagonal(
        [tidy(spark.read.option("header", True).option("inferSchema", False).csv(p)) for p in paths]
    )


def combine_post2018(
    spark: SparkSession, panel_folder: str, ts_folder: str, save_folder: str, first: int = 2018, last: int = 2023
) -> DataFrame:
    panel = _parquet_years(spark, panel_folder, first, last)
    ts = _parquet_years(spark, ts_folder, first, last)
    combined = lenders_post2018(panel, ts)
    write_lenders(combined, save_folder, first, last)
    return combined


def combine_2007_2017(
    spark: SparkSession, panel_folder: str, ts_folder: str, save_folder: str, first: int = 2007, last: int = 2017
) -> DataFrame:
    panel = _csv_years(spark, panel_folder, first, last, tidy_panel_2007_2017)
    ts = _csv_years(spark, ts_folder, first, last, tidy_ts_2007_2017)
    combined = lenders_2007_2017(panel, ts)
    write_lenders(combined, save_folder, first, last, parquet=False)
    return combined


def summarize_post2018(combined: DataFrame) -> Mapping[str, object]:
    return validate_lenders(combined, LENDER_KEYS_POST2018, range(2018, 2025))


def summarize_2007_2017(combined: DataFrame) -> Mapping[str, object]:
    return validate_lenders(combined, LENDER_KEYS_2007_2017[:2], range(2007, 2018))
