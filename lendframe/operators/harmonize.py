"""Bronze text to typed silver columns, one projection per era.

Every rule applies only to the columns present. Rules are composed into one
expression per column and emitted as a single ``select``, so the plan stays flat
however many columns a file has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..eras import (
    DERIVED_COLUMNS,
    PERIOD_2007_2017,
    POST2018,
    POST2018_EXEMPT_COLUMNS,
    PRE2007,
    SENTINEL,
    Era,
)
from ..functions import codes
from ..functions.casts import (
    code_text,
    col,
    is_double,
    map_number,
    map_text,
    round_half_away,
    to_double,
    to_whole,
    whole_code,
    zero_pad,
)
from .columns import drop_present, rename_legacy

Rule = Callable[[Column], Column]
EXEMPT = {"Exempt": SENTINEL}


class _Projection:
    """Collects one expression per column and emits one select."""

    def __init__(self, df: DataFrame):
        self.df = df
        self.text = {name for name, kind in df.dtypes if kind == "string"}
        self.exprs = {name: col(name) for name in df.columns}

    def cast(self, names: Iterable[str], rule: Rule) -> "_Projection":
        """Apply a rule to text columns; the first rule for a column wins."""
        for name in names:
            if name in self.text:
                self.exprs[name] = rule(col(name))
                self.text.discard(name)
        return self

    def change(self, name: str, rule: Rule) -> "_Projection":
        if name in self.exprs:
            self.exprs[name] = rule(self.exprs[name])
        return self

    def frame(self) -> DataFrame:
        return self.df.select(*[e.alias(n) for n, e in self.exprs.items()])


def thousands_to_dollars(amount: Column) -> Column:
    return F.try_multiply(amount, F.lit(1000).cast("bigint"))


def income_to_dollars(amount: Column) -> Column:
    """Thousands to dollars, the sentinel kept."""
    return F.try_multiply(amount, F.when(amount == SENTINEL, 1).otherwise(1000).cast("bigint"))


def exempt_to_sentinel(text: Column) -> Column:
    return map_text(text, EXEMPT)


def exempt_or_whole(text: Column) -> Column:
    return map_number(text, EXEMPT)


def exempt_or_double(text: Column) -> Column:
    return map_number(text, EXEMPT, "double", is_double(text))


def units_code(text: Column) -> Column:
    return map_number(text, codes.UNIT_BUCKETS, "smallint")


def age_code(text: Column) -> Column:
    return map_number(text, codes.AGE_BUCKETS, "smallint")


def age62_code(text: Column) -> Column:
    return map_number(text, codes.AGE62_FLAGS, "smallint")


def dti_code(text: Column) -> Column:
    return map_number(text, codes.DTI_BUCKETS)


def conforming_code(text: Column) -> Column:
    return map_number(text, codes.CONFORMING_CODES)


def harmonize_post2018(df: DataFrame) -> DataFrame:
    """Typed 2018+ columns. Expects current names (see ``rename_legacy``)."""
    exempt = set(POST2018_EXEMPT_COLUMNS)
    return (
        _Projection(df)
        .cast(["total_units"], units_code)
        .cast(["applicant_age", "co_applicant_age"], age_code)
        .cast(["applicant_age_above_62", "co_applicant_age_above_62"], age62_code)
        .cast(["debt_to_income_ratio"], dti_code)
        .cast(["conforming_loan_limit"], conforming_code)
        .cast([c for c in POST2018.floats if c in exempt], exempt_or_double)
        .cast([c for c in POST2018.integers if c in exempt], exempt_or_whole)
        .cast(POST2018.floats, to_double)
        .cast(POST2018.integers, to_whole)
        .change("income", income_to_dollars)
        .cast(["census_tract"], lambda c: code_text(c, 11))
        .cast(["county_code"], lambda c: code_text(c, 5))
        .frame()
    )


def _cast_and_scale(df: DataFrame, era: Era) -> DataFrame:
    """Numbers to their types, money columns from thousands to dollars."""
    return (
        _Projection(df)
        .cast(era.floats, to_double)
        .cast(era.integers, to_whole)
        .change("loan_amount", thousands_to_dollars)
        .change("income", thousands_to_dollars)
        .frame()
    )


def geo_pre2018(df: DataFrame) -> DataFrame:
    """State 2, county 5, tract 11 and metro 5 digits as text; null if a part is.

    County needs the state and tract needs both, so each is left as it is when a
    part is missing from the frame.
    """
    present = set(df.columns)
    state = whole_code(col("state_code"), 2)
    county = F.concat(state, whole_code(col("county_code"), 3))
    hundredths = round_half_away(to_double(col("census_tract")) * 100)
    tract = F.concat(state, F.substring(county, -3, 3), zero_pad(hundredths.cast("string"), 6))
    codes_by_name = {}
    if "state_code" in present:
        codes_by_name["state_code"] = state
        if "county_code" in present:
            codes_by_name["county_code"] = county
            if "census_tract" in present:
                codes_by_name["census_tract"] = tract
    if "msa_md" in present:
        codes_by_name["msa_md"] = code_text(col("msa_md"), 5)
    return df.select(*[codes_by_name.get(c, col(c)).alias(c) for c in df.columns])


def silver_post2018(bronze: DataFrame) -> DataFrame:
    return harmonize_post2018(rename_legacy(bronze))


def silver_2007_2017(
    bronze: DataFrame,
    file_type: str | Column | None = None,
    year: int | None = None,
    drop_tract_vars: bool = True,
) -> DataFrame:
    """Typed 2007-2017 columns; ``file_type`` and ``year`` fill missing keys."""
    df = geo_pre2018(_cast_and_scale(rename_legacy(bronze), PERIOD_2007_2017))
    df = drop_present(df, DERIVED_COLUMNS)
    if drop_tract_vars:
        df = drop_present(df, PERIOD_2007_2017.tracts)
    if "activity_year" not in df.columns and year is not None:
        df = df.withColumn("activity_year", F.lit(year).cast("bigint"))
    if file_type is not None:
        df = df.withColumn("file_type", F.lit(file_type))
    return df


def silver_pre2007(bronze: DataFrame) -> DataFrame:
    return geo_pre2018(_cast_and_scale(rename_legacy(bronze), PRE2007))
