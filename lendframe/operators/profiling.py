"""Value tables, type candidates, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..eras import INDEX_COLUMN
from ..functions.casts import col
from ..session import cut_lineage

# Columns left out of value tables, rows shown per column.
SKIPPED = (INDEX_COLUMN, "loan_to_value_ratio", "combined_loan_to_value_ratio", "rate_spread")
TOP_VALUES = 50
EXAMPLES = 5


def tabulate_values(
    df: DataFrame, skip: Sequence[str] = SKIPPED, top: int = TOP_VALUES
) -> DataFrame:
    """The most frequent values of every column, in one pass over the table.

    Columns are unpivoted and counted before the shuffle. Ties in count are
    ordered by value, null last. Ranks are cut per task before the second shuffle.
    """
    names = [c for c in df.columns if c not in skip]
    text = df.select(*[col(c).cast("string").alias(c) for c in names])
    counts = (
        text.unpivot([], [col(c) for c in names], "column_name", "value")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )
    order = W.partitionBy("column_name").orderBy(F.desc("cnt"), F.asc_nulls_last("value"))
    return counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _drop_first(text: Column, mark: str) -> Column:
    return F.regexp_replace(text, rf"^([^{mark}]*)[{mark}]", "$1")


def type_candidates(tabulated: DataFrame) -> DataFrame:
    """Per column: ``integer``, ``float`` or ``mixed`` by its tabulated values.

    Null where a column has no value. ``examples`` lists the first values that are
    not plain decimals.
    """
    value = F.col("value")
    unsigned = F.regexp_replace(value, "^-+", "")
    bare = unsigned
    for mark in ".eE+":
        bare = _drop_first(bare, mark)
    digits = "^[0-9]+$"
    odd = ~_drop_first(unsigned, ".").rlike(digits)
    entry = F.when(value.isNotNull() & odd, F.struct("rank", "value"))
    return (
        tabulated.groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.sum("cnt").alias("n_rows"),
            F.bool_and(unsigned.rlike(digits)).alias("whole"),
            F.bool_and(bare.rlike(digits)).alias("decimal"),
            F.slice(F.array_sort(F.collect_list(entry)), 1, EXAMPLES).alias("odd"),
        )
        .select(
            "column_name",
            "n_values",
            "n_rows",
            F.when(F.col("whole"), "integer")
            .when(F.col("decimal"), "float")
            .when(F.col("whole").isNotNull(), "mixed")
            .alias("candidate"),
            F.array_join(F.col("odd.value"), ", ").alias("examples"),
        )
    )


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    counts = df.groupBy(col(column)).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.desc("cnt"), F.asc_nulls_last(column)).limit(n)


def density_histogram(
    df: DataFrame, value: str, by: Sequence[str], bins: int = 100
) -> DataFrame:
    """Equal-width histogram per group over the group's own range, empty bins included.

    ``density`` integrates to one per group. A group with a single value gets a
    range of one around it.
    """
    number = col(value).cast("double")
    keys = [col(c) for c in by]
    low, high = F.min(number), F.max(number)
    flat = F.when(low == high, 0.5).otherwise(0.0)
    spans = cut_lineage(
        df.filter(number.isNotNull())
        .groupBy(*keys)
        .agg((low - flat).alias("_lo"), (high + flat).alias("_hi"), F.count(number).alias("_n"))
        .withColumnsRenamed({c: f"_by{i}" for i, c in enumerate(by)})
    )
    same = F.lit(True)
    for i, c in enumerate(by):
        same = same & col(c).eqNullSafe(F.col(f"_by{i}"))
    place = F.floor((number - F.col("_lo")) * bins / (F.col("_hi") - F.col("_lo"))).cast("int")
    counts = (
        df.filter(number.isNotNull())
        .join(spans, same)
        .groupBy(*keys, F.least(place, F.lit(bins - 1)).alias("_bin"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    grid = spans.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("_hi") - F.col("_lo")) / bins
    return grid.join(counts, same & (F.col("bin") == F.col("_bin")), "left").select(
        *[F.col(f"_by{i}").alias(c) for i, c in enumerate(by)],
        "bin",
        (F.col("_lo") + width * F.col("bin")).alias("left_edge"),
        F.coalesce("_count", F.lit(0)).cast("bigint").alias("cnt"),
        (F.coalesce("_count", F.lit(0)) / (F.col("_n") * width)).alias("density"),
    )
