"""Missing values, names, crosswalk, plausibility and outlier flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..eras import (
    CLEANING_NUMERIC_COLUMNS,
    CLEANING_RENAMES_POST2018,
    CLEANING_RENAMES_PRE2018,
    SENTINEL,
)
from ..functions.casts import col, number
from ..session import written_and_measured
from .columns import rename_present
from .quantiles import exact_quantiles

# Words that stand for a missing value.
NA_WORDS = ("NA", "N/A", "Exempt", "Not Applicable", "NA   ", "nan")
NA_WORDS_DERIVED = ("NA", "N/A", "Exempt", "Not Applicable")

# Plausible ranges, both ends included.
PLAUSIBLE = {
    "ltv": (0, 200),
    "credit_score": (500, 820),
    "dti": (0, 250),
    "applicant_income": (0, 1_000_000),
    "loan_amount": (0, 1_500_000),
}
MAX_RATE_SPREAD = 20
PLAUSIBILITY_DROPPED = "_metadata_plausibility_dropped"
OUTLIER_COLUMNS = ("interest_rate", "rate_spread", "total_loan_costs")
Z_LIMIT = 6.0

Bounds = Mapping[str, tuple[float | None, float | None]]


def na_to_null(
    df: DataFrame, columns: Sequence[str] | None = None, words: Sequence[str] = NA_WORDS
) -> DataFrame:
    """Missing-value words to null in text columns."""
    chosen = set(df.columns if columns is None else columns)
    text = [name for name, kind in df.dtypes if kind == "string" and name in chosen]
    return df.replace({word: None for word in words}, subset=text) if text else df


def coerce_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    kinds = dict(df.dtypes)
    chosen = set(columns)
    return df.select(
        *[number(col(c), kinds[c]).alias(c) if c in chosen else col(c) for c in df.columns]
    )


def standardize_schema(
    df: DataFrame, post2018: bool, renames: Mapping[str, str] | None = None
) -> DataFrame:
    """Cleaning names, then the six measured columns to double."""
    pairs = dict(CLEANING_RENAMES_POST2018 if post2018 else CLEANING_RENAMES_PRE2018)
    pairs.update(renames or {})
    return coerce_double(rename_present(df, pairs), CLEANING_NUMERIC_COLUMNS)


def missing_and_derived(df: DataFrame, post2018: bool) -> DataFrame:
    """Missing words to null everywhere; derived demographics copied to short names."""
    out = na_to_null(df, words=NA_WORDS_DERIVED)
    if not post2018:
        return out
    copies = {
        short: col(f"derived_{short}")
        for short in ("race", "ethnicity", "sex")
        if f"derived_{short}" in out.columns
    }
    return out.withColumns(copies) if copies else out


def crosswalk_tract(
    df: DataFrame,
    crosswalk: DataFrame | None,
    tract_col: str = "census_tract",
    year_col: str = "activity_year",
    to_vintage: int | None = 2020,
    crosswalk_cols: tuple[str, str] = ("tract_src", "tract_2020"),
) -> DataFrame:
    """Map tracts to the target vintage; tracts not listed stay as they are.

    A source tract listed more than once yields one row per target.
    """
    source, target = crosswalk_cols
    if crosswalk is None or not {tract_col, year_col} <= set(df.columns):
        return df
    if not {source, target} <= set(crosswalk.columns):
        return df
    if "target_year" in crosswalk.columns and to_vintage is not None:
        crosswalk = crosswalk.filter(F.col("target_year") == to_vintage)
    side = [col(source).alias("_from"), col(target).alias("_to")]
    match = col(tract_col) == F.col("_from")
    if "year" in crosswalk.columns:
        kind = dict(df.dtypes)[year_col]
        side.append(F.col("year").cast(kind).alias("_year"))
        match = match & (col(year_col) == F.col("_year"))
    joined = df.join(crosswalk.select(*side), match, "left")
    return joined.select(
        *[
            F.coalesce(F.col("_to"), col(c)).alias(c) if c == tract_col else col(c)
            for c in df.columns
        ]
    )


def plausible(df: DataFrame, bounds: Bounds | None = None, literal: bool = False) -> Column:
    """Condition a row must meet; null passes.

    ``literal`` joins lower and upper bound by "or", which lets any row pass that
    meets one of them.
    """
    limits: dict[str, tuple[float | None, float | None]] = {**PLAUSIBLE, **(bounds or {})}
    kinds = dict(df.dtypes)
    keep = F.lit(True)
    for name, (low, high) in limits.items():
        if name not in kinds:
            continue
        value = number(col(name), kinds[name])
        tests = [] if low is None else [value >= low]
        tests += [] if high is None else [value <= high]
        if tests:
            join = (lambda a, b: a | b) if literal else (lambda a, b: a & b)
            keep = keep & (value.isNull() | reduce(join, tests))
    return keep


def plausibility_filter(
    df: DataFrame, bounds: Bounds | None = None, literal: bool = False
) -> DataFrame:
    """Rows within bounds, with the number of rows dropped as a column.

    The rows kept are written once and the others counted by the way: ``df`` is made once.
    """
    keep = plausible(df, bounds, literal)
    out, dropped = written_and_measured(df, F.count_if(~keep), keep)
    return out.withColumn(PLAUSIBILITY_DROPPED, F.lit(dropped or 0).cast("bigint"))


def clean_rate_spread(df: DataFrame, rate_spread_col: str = "rate_spread") -> DataFrame:
    """Rate spreads beyond 20 points either way to null."""
    if rate_spread_col not in df.columns:
        return df
    value = number(col(rate_spread_col), dict(df.dtypes)[rate_spread_col])
    return df.withColumn(rate_spread_col, F.when(~(F.abs(value) > MAX_RATE_SPREAD), value))


def mean_and_deviation(values: Mapping[str, Column]) -> list[Column]:
    """Aggregates ``mean_{c}`` and ``std_{c}`` of each value."""
    return [
        *[F.avg(v).alias(f"mean_{c}") for c, v in values.items()],
        *[F.stddev_samp(v).alias(f"std_{c}") for c, v in values.items()],
    ]


def flag_outliers(
    df: DataFrame,
    columns: Sequence[str] = OUTLIER_COLUMNS,
    z_limit: float = Z_LIMIT,
    stats: Row | None = None,
) -> DataFrame:
    """``outlier_{c}``: further than ``z_limit`` sample deviations from the mean.

    One aggregate covers all columns, unless its row ``stats`` is given. A column without
    spread gets no flag.
    """
    kinds = dict(df.dtypes)
    chosen = [c for c in columns if c in kinds]
    if not chosen:
        return df
    value = {c: number(col(c), kinds[c]) for c in chosen}
    if stats is None:
        stats = df.agg(*mean_and_deviation(value)).first()
    flags = {}
    for c, v in value.items():
        mean, std = stats[f"mean_{c}"], stats[f"std_{c}"]
        if std is not None and std > 0:
            flags[f"outlier_{c}"] = F.abs(v - F.lit(mean)) > z_limit * std
    return df.withColumns(flags) if flags else df


def sentinel_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    chosen = set(columns)
    return df.select(
        *[F.nullif(col(c), F.lit(SENTINEL)).alias(c) if c in chosen else col(c) for c in df.columns]
    )


def medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact median of each column present."""
    chosen = [c for c in columns if c in df.columns]
    return {c: q[0] for c, q in exact_quantiles(df, chosen, [0.5]).items()}


def fill_null(df: DataFrame, values: Mapping[str, float | None]) -> DataFrame:
    return df.select(
        *[
            F.coalesce(col(c).cast("double"), F.lit(values[c]).cast("double")).alias(c)
            if c in values
            else col(c)
            for c in df.columns
        ]
    )


def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls to the column median; a column with no value at all stays null."""
    return fill_null(df, medians(df, columns))


def quantile_trim(
    df: DataFrame, column: str, low: float = 0.01, high: float = 0.99
) -> DataFrame:
    """Rows at or above the low quantile and below the high one."""
    at_low, at_high = exact_quantiles(df, [column], [low, high])[column]
    value = col(column).cast("double")
    return df.filter((value >= F.lit(at_low)) & (value < F.lit(at_high)))
