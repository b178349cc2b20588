"""The cleaning job in its fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.casts import col, number
from ..operators.cleaning import (
    OUTLIER_COLUMNS,
    PLAUSIBILITY_DROPPED,
    PLAUSIBLE,
    Bounds,
    clean_rate_spread,
    crosswalk_tract,
    flag_outliers,
    mean_and_deviation,
    missing_and_derived,
    plausible,
    sentinel_to_null,
    standardize_schema,
)
from ..operators.identity import DEDUP_DROPPED, RECORD_KEY, add_record_key, deduplicate


def clean_loans(
    df: DataFrame,
    post2018: bool,
    order_by: str,
    bounds: Bounds | None = None,
    crosswalk: DataFrame | None = None,
    null_keys: str = "keep",
) -> DataFrame:
    """Key, last copy per key, names, missing values, sentinels, tracts, bounds, spreads, flags.

    Two passes over the input. The first reads the key, the position and the measured
    columns and yields one row: how many rows there are, how many are no copies and how
    many of these the bounds drop, mean and deviation of what is left. The second makes
    the result with these figures as constants. No row is written in between. A tract
    should occur once per vintage in ``crosswalk``; what it repeats is not counted.
    """
    keyed = add_record_key(df, post2018)
    figures = _figures(keyed, post2018, order_by, bounds, null_keys)
    unique = deduplicate(keyed, order_by, keep="last", null_keys=null_keys, count_dropped=False)
    copies = F.lit(figures["rows"] - figures["unique"]).cast("bigint")
    named = _named(unique.withColumn(DEDUP_DROPPED, copies), post2018, bounds)
    mapped = crosswalk_tract(named, crosswalk)
    bounded = mapped.filter(plausible(mapped, bounds)).withColumn(
        PLAUSIBILITY_DROPPED, F.lit(figures["dropped"]).cast("bigint")
    )
    return flag_outliers(clean_rate_spread(bounded), stats=figures)


def _named(df: DataFrame, post2018: bool, bounds: Bounds | None) -> DataFrame:
    named = missing_and_derived(standardize_schema(df, post2018), post2018)
    # a typed table marks exempt values by a number that must neither fail a bound nor enter a mean
    measured = {*PLAUSIBLE, *(bounds or {}), *OUTLIER_COLUMNS}
    numeric = [c for c, kind in named.dtypes if c in measured and kind != "string"]
    return sentinel_to_null(named, numeric)


def _figures(keyed: DataFrame, post2018: bool, order_by: str, bounds: Bounds | None, null_keys: str):
    """One row: ``rows``, ``unique``, ``dropped``, and mean and deviation of each outlier column.

    The last copy of a key is a maximum, taken per task before the shuffle.
    """
    named = clean_rate_spread(_named(keyed, post2018, bounds))
    kinds = dict(named.dtypes)
    values = {c: number(col(c), kinds[c]) for c in OUTLIER_COLUMNS if c in kinds}
    last = F.struct(
        col(order_by), plausible(named, bounds).alias("_keep"), *[v.alias(f"_{c}") for c, v in values.items()]
    )
    alone = F.when(F.col(RECORD_KEY).isNull(), col(order_by)) if null_keys == "keep" else F.lit(None)
    by_key = named.groupBy(F.col(RECORD_KEY), alone.cast("string").alias("_alone")).agg(
        F.count(F.lit(1)).alias("_copies"), F.max(last).alias("_last")
    )
    kept = {c: F.when(F.col("_last._keep"), F.col(f"_last._{c}")) for c in values}
    return by_key.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("unique"),
        F.count_if(~F.col("_last._keep")).alias("dropped"),
        *mean_and_deviation(kept),
    ).first()
