"""The stored table of tract statistics, one row per year and tract."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..eras import POST2018_TRACT_COLUMNS
from ..functions.casts import col
from ..operators.tracts import split_tracts
from ..sources.layers import path_exists

YEAR = "activity_year"


def merge_tracts(loans: DataFrame, path: str, columns: Sequence[str] = POST2018_TRACT_COLUMNS) -> DataFrame:
    """Add the tract statistics of ``loans`` that the table at ``path`` lacks; the whole table.

    Rows of one year are compared with the stored rows of that year alone, and only new rows
    are written, beside the old ones; a merge that runs twice adds nothing. Null equals null.
    """
    spark = loans.sparkSession
    _, tracts = split_tracts(loans, columns)
    fields = [c for c in tracts.columns if c != YEAR]
    if path_exists(spark, path):
        stored = read_tracts(tracts, path)
        shadow = stored.select(*[col(c).alias(f"_{c}") for c in tracts.columns])
        same = reduce(and_, [col(c).eqNullSafe(F.col(f"`_{c}`")) for c in tracts.columns])
        tracts = tracts.join(shadow, same, "left_anti")
    tracts.select(*[col(c) for c in [*fields, YEAR]]).write.mode("append").partitionBy(YEAR).parquet(path)
    return read_tracts(tracts, path)


def read_tracts(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*[col(c) for c in like.columns])
