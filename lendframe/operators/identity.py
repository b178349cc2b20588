"""Record keys, deduplication and dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..eras import INDEX_COLUMN
from ..functions.casts import col, strip, zero_pad
from ..session import cut_lineage, written_and_measured
from .quantiles import approximate_cuts

RECORD_KEY = "hmda_record_key"
KEY_JOIN = "||"
DEDUP_DROPPED = "_metadata_dedup_dropped"


def add_record_key(
    df: DataFrame,
    post2018: bool,
    uli_col: str = "universal_loan_identifier",
    lei_col: str = "lei",
    respondent_id_col: str = "respondent_id",
    agency_col: str = "agency_code",
    seq_col: str = "sequence_number",
) -> DataFrame:
    """Trimmed key parts joined by ``||``; null if a part is; absent parts are added as null."""
    names = [lei_col, uli_col] if post2018 else [respondent_id_col, agency_col, seq_col]
    absent = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    if absent:
        df = df.withColumns(absent)
    parts: list[Column] = []
    for name in names:
        parts += [F.lit(KEY_JOIN), strip(col(name).cast("string"))]
    return df.withColumn(RECORD_KEY, F.concat(*parts[1:]))


def deduplicate(
    df: DataFrame,
    order_by: str,
    keep: str = "last",
    subset: Sequence[str] = (RECORD_KEY,),
    null_keys: str = "keep",
    count_dropped: bool = True,
) -> DataFrame:
    """One row per key by source position ``order_by``, which must be unique.

    ``keep`` is ``first``, ``last``, ``any`` or ``none`` (drop every copy). With
    ``null_keys="keep"`` rows without a key are all kept; ``"collapse"`` treats
    null as one key. ``_metadata_dedup_dropped`` holds the number of rows dropped.

    Rows are cut to one (two for ``none``) per key before the shuffle, so a key held by a
    large share of all rows costs no more than any other; keyless rows are spread by
    their position. Counting what is dropped needs all copies: each task then sends one
    row per key with its number of copies, and the result is written once, so that the
    figure, known at the end, can stand in every row.
    """
    if keep not in ("first", "last", "any", "none"):
        raise ValueError(f"unknown keep: {keep}")
    missing = [c for c in subset if c not in df.columns]
    if missing:
        raise ValueError(f"add the record key before removing duplicates: {missing}")
    keys = [col(c) for c in subset]
    any_null = reduce(lambda a, b: a | b, [k.isNull() for k in keys])
    if count_dropped:
        return _counted(df, subset, any_null if null_keys == "keep" else None, order_by, keep)
    place = col(order_by).desc() if keep == "last" else col(order_by).asc()
    if null_keys == "keep":
        marked = df.withColumn("_spread", F.when(any_null, col(order_by)))
        by_key = W.partitionBy(*keys, "_spread")
    else:
        marked, by_key = df, W.partitionBy(*keys)
    top = 2 if keep == "none" else 1
    out = marked.withColumn("_rank", F.row_number().over(by_key.orderBy(place)))
    out = out.filter(F.col("_rank") <= top)
    if keep == "none":
        out = out.withColumn("_copies", F.count(F.lit(1)).over(by_key))
        out = out.filter(F.col("_copies") == 1).drop("_copies")
    out = out.drop("_rank", "_spread")
    return out


def _counted(df: DataFrame, subset: Sequence[str], alone: Column | None, order_by: str, keep: str) -> DataFrame:
    """One row per key and the number of rows dropped, with one shuffle; rows that are ``alone`` are kept.

    A key of plain text travels as the key alone, not again within the row: grouping changes no such
    value, while it makes 0.0 of -0.0.
    """
    spread = F.lit(None) if alone is None else F.when(alone, col(order_by)).cast("string")
    kinds = dict(df.dtypes)
    once = {c: f"_key{i}" for i, c in enumerate(subset) if kinds[c] == "string" and c != order_by}
    row = F.struct(*[col(c) for c in df.columns if c not in once])
    pick = F.max_by if keep == "last" else F.min_by
    by_key = df.groupBy(*[col(c).alias(f"_key{i}") for i, c in enumerate(subset)], spread.alias("_spread")).agg(
        pick(row, col(order_by)).alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    copies = F.col("_copies")
    lost = F.when(copies > 1, copies).otherwise(0) if keep == "none" else copies - 1
    out, dropped = written_and_measured(by_key, F.sum(lost), copies == 1 if keep == "none" else None)
    dropped = F.lit(dropped or 0).cast("bigint").alias(DEDUP_DROPPED)

    def value(name: str) -> Column:
        # no row is found where no copy has a position
        found = F.when(F.col("_row").isNotNull(), F.col(once[name])) if name in once else F.col("_row")[name]
        return found.alias(name)

    return out.select(*[value(c) for c in df.columns], dropped)


def index_label(year: Column, file_type: Column, position: Column) -> Column:
    """``2018a_000000000``: year, type code, zero-based row number in nine digits."""
    return F.concat(
        year.cast("string"), file_type, F.lit("_"), zero_pad(position.cast("string"), 9)
    )


def dense_position(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: str,
    name: str = "_position",
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """Zero-based row number within a group, ordered by a unique numeric column.

    No group is sorted in one task: the order column is cut into slices at its
    approximate quantiles, rows are ranked inside (group, slice), and the counts
    of the earlier slices are added. One shuffle of the rows.
    """
    value = col(order_by).cast("double")
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")
    ).first()
    slices = facts["n"] // rows_per_slice + 1
    cuts: list[float] = []
    if slices > 1 and facts["lo"] < facts["hi"]:
        cuts = approximate_cuts(df.select(value.alias("v")), slices, facts["n"])
    if cuts:
        edges = [float("-inf"), *cuts, float("inf")]
        sliced = Bucketizer(splits=edges, inputCol="_at", outputCol="_slice").transform(
            df.withColumn("_at", value)
        ).drop("_at").withColumn("_slice", F.col("_slice").cast("int"))
    else:
        sliced = df.withColumn("_slice", F.lit(0))
    keys = [col(c) for c in group_by]
    counts = sliced.groupBy(*keys, F.col("_slice")).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[col(c).alias(f"_k{i}") for i, c in enumerate(group_by)],
        F.col("_slice").alias("_s"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
    )
    local = W.partitionBy(*keys, F.col("_slice")).orderBy(col(order_by))
    ranked = sliced.withColumn("_rank", F.row_number().over(local))
    same = F.col("_slice") == F.col("_s")
    for i, c in enumerate(group_by):
        same = same & col(c).eqNullSafe(F.col(f"_k{i}"))
    out = ranked.join(cut_lineage(offsets), same, "left")
    return out.withColumn(
        name, (F.col("_offset") + F.col("_rank") - 1).cast("bigint")
    ).drop("_slice", "_s", "_rank", "_offset", *[f"_k{i}" for i in range(len(group_by))])


def add_index(
    df: DataFrame,
    order_by: str,
    year_col: str = "activity_year",
    type_col: str = "file_type",
) -> DataFrame:
    """Row key over rows that carry an explicit source position."""
    placed = dense_position(df, [year_col, type_col], order_by)
    label = index_label(col(year_col), col(type_col), F.col("_position"))
    return placed.withColumn(INDEX_COLUMN, label).drop("_position")
