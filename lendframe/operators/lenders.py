"""Lender directory joins and their checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..eras import (
    LENDER_KEYS_2007_2017,
    LENDER_KEYS_POST2018,
    PANEL_RENAMES_2007_2017,
    TS_DROPPED_2007_2017,
)
from ..functions.casts import col, strip
from .columns import rename_present, sort_columns


def outer_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], suffixes: tuple[str, str]
) -> DataFrame:
    """Full outer join in which null keys match, columns in code-point order.

    Non-key columns found on both sides take the suffixes. Written as a left join
    plus the unmatched right rows, so that adaptive execution can split a key that
    many rows share, which it cannot do for a full outer join.
    """
    clashes = (set(left.columns) & set(right.columns)) - set(keys)
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clashes})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clashes})
    shadow = {k: f"_key{i}" for i, k in enumerate(keys)}

    def same(key: str):
        return col(key).eqNullSafe(F.col(shadow[key]))

    match = reduce(lambda a, b: a & b, [same(k) for k in keys])
    matched = left.join(right.withColumnsRenamed(shadow), match, "left").drop(*shadow.values())
    seen = left.select(*[col(k).alias(shadow[k]) for k in keys]).distinct()
    return sort_columns(
        matched.unionByName(right.join(seen, match, "left_anti"), allowMissingColumns=True)
    )


def lenders_post2018(panel: DataFrame, ts: DataFrame) -> DataFrame:
    return outer_join(panel, ts, LENDER_KEYS_POST2018, ("_panel", "_ts"))


def strip_blank(df: DataFrame) -> DataFrame:
    """Trim text columns; what is left empty becomes null."""
    return df.select(
        *[
            F.nullif(strip(col(name)), F.lit("")).alias(name) if kind == "string" else col(name)
            for name, kind in df.dtypes
        ]
    )


def tidy_ts_2007_2017(ts: DataFrame) -> DataFrame:
    """Trim headers, drop the columns the panel repeats."""
    return rename_present(ts, {c: c.strip() for c in ts.columns}).drop(*TS_DROPPED_2007_2017)


def tidy_panel_2007_2017(panel: DataFrame) -> DataFrame:
    return rename_present(panel, PANEL_RENAMES_2007_2017)


def lenders_2007_2017(panel: DataFrame, ts: DataFrame) -> DataFrame:
    joined = outer_join(
        tidy_panel_2007_2017(panel),
        tidy_ts_2007_2017(ts),
        LENDER_KEYS_2007_2017,
        (" Panel", " TS"),
    )
    return strip_blank(joined)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of keys held by more than one row."""
    groups = df.groupBy(*[col(k) for k in keys]).count()
    return groups.filter("count > 1").agg(F.count(F.lit(1)).alias("duplicate_keys"))


def table_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, column count and which key columns are absent."""
    absent = [k for k in keys if k not in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.lit(",".join(absent)).alias("missing_key_columns"),
    )


def missing_years(df: DataFrame, years: Iterable[int], year_col: str = "activity_year") -> DataFrame:
    """Expected years the table lacks."""
    years = list(years)
    expected = df.sparkSession.range(min(years), max(years) + 1).toDF("missing_year")
    expected = expected.filter(F.col("missing_year").isin(years))
    present = df.select(col(year_col).try_cast("bigint").alias("_year")).distinct()
    return expected.join(present, F.col("missing_year") == F.col("_year"), "left_anti")


def lenders_per_year(df: DataFrame, year_col: str = "activity_year") -> DataFrame:
    return df.groupBy(col(year_col)).agg(F.count(F.lit(1)).alias("lender_count"))


def validate_lenders(df: DataFrame, keys: Sequence[str], years: Iterable[int]) -> Mapping[str, object]:
    """The checks above as one small report; every action returns a bounded result."""
    profile = table_profile(df, keys).first()
    report: dict[str, object] = {
        "rows": profile["rows"],
        "columns": profile["columns"],
        "missing_key_columns": [k for k in profile["missing_key_columns"].split(",") if k],
    }
    if keys[0] in df.columns:
        report["missing_years"] = sorted(
            r["missing_year"] for r in missing_years(df, years, keys[0]).collect()
        )
    if not report["missing_key_columns"]:
        report["duplicate_keys"] = duplicate_keys(df, keys).first()["duplicate_keys"]
    return report
