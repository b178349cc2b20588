"""Known and rule-based value corrections with an audit trail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..eras import INDEX_COLUMN, SENTINEL
from ..functions.casts import col
from ..session import cut_lineage
from .quantiles import exact_quantiles

# Lenders known to report a field in the wrong unit:
# lender, year, type, field, factor, least value corrected, note. Without a factor the
# field is set missing; with a least value only records above it are corrected.
KNOWN_CORRECTIONS = (
    ("549300CCELEPUO4TOE73", 2018, "a", "income", 0.001, None, "income in dollars"),
    ("2549001LVVJUGK9VA038", 2018, "a", "income", 0.001, None, "income in dollars"),
    ("549300CKKPTDS03YHG30", 2018, "a", "income", 0.001, None, "income in dollars"),
    ("5493000RRYPUX5O9MI08", 2018, "a", "income", 0.001, None, "income in dollars"),
    ("549300CCELEPUO4TOE73", 2018, "a", "interest_rate", 100.0, None, "rate as a fraction"),
    ("549300JD2HS86SAFVA88", 2018, "a", "discount_points", None, None, "placeholder 8888"),
    ("2549001UO7C3LB3SXA82", 2019, "a", "combined_loan_to_value_ratio", 100.0, None, "ratio as a fraction"),
    ("MZJU01BGQ7J1KULQSB89", 2019, "a", "combined_loan_to_value_ratio", 100.0, None, "ratio as a fraction"),
    ("549300C8GOC4OYUV0Z32", 2019, "a", "combined_loan_to_value_ratio", 100.0, None, "ratio as a fraction"),
    ("5493009TOEDMWVNG1442", 2020, "a", "income", 0.001, None, "income in dollars"),
    ("54930057XF33SONJFP81", 2020, "a", "income", 0.001, 900_000.0, "some incomes in dollars"),
    ("254900Z5QRSHW4Y8CR51", 2020, "a", "loan_term", None, None, "one month for every loan"),
    ("549300G3FCPL48R4HU28", 2022, "b", "income", 0.012, None, "monthly income in dollars"),
    ("5493009TOEDMWVNG1442", 2022, "b", "income", 0.012, None, "monthly income in dollars"),
    ("984500DA79C1B97ACF16", 2022, "b", "income", 0.012, None, "monthly income in dollars"),
    ("B2S31CFVSWTN3FR00Q90", 2022, "b", "loan_amount", 0.01, None, "amount times 100"),
)

# Records to look at by hand and not to change:
# lender, year, type, field, least value flagged, reason.
REVIEWS = (
    ("MZJU01BGQ7J1KULQSB89", 2019, "a", "loan_amount", None, "amount large, several families or wrong unit"),
    ("B2S31CFVSWTN3FR00Q90", 2019, "a", "loan_amount", None, "amount large, several families or wrong unit"),
    ("5493002W52M3SYLFEX32", 2022, "b", "loan_term", 480.0, "large 40-year loan to one purchaser"),
)

FIELDS = (
    "income",
    "interest_rate",
    "discount_points",
    "combined_loan_to_value_ratio",
    "loan_amount",
    "loan_term",
)
KEYS = ("lei", "activity_year", "file_type")


@dataclass(frozen=True)
class Rule:
    """Multiply a field by ``factor`` where it lies strictly between two bounds."""

    field: str
    above: float
    below: float
    factor: float


# Unit rules. Income bounds are in thousands in the rule's source and
# in dollars here, as in silver.
RULES = (
    Rule("income", 900_000, 10_000_000_000, 0.001),
    Rule("interest_rate", 0, 1.0, 100),
    Rule("combined_loan_to_value_ratio", 0, 2.0, 100),
)


def known_corrections(spark: SparkSession) -> DataFrame:
    schema = (
        "lei string, activity_year bigint, file_type string, "
        "field string, factor double, above double, note string"
    )
    return spark.createDataFrame(list(KNOWN_CORRECTIONS), schema)


def known_reviews(spark: SparkSession) -> DataFrame:
    schema = "lei string, activity_year bigint, file_type string, field string, least double, reason string"
    return spark.createDataFrame(list(REVIEWS), schema)


def review_flags(df: DataFrame, reviews: DataFrame) -> DataFrame:
    """``review_flag`` and ``review_reasons`` (joined by a semicolon); no value is changed.

    A record is flagged for a field of its lender's that has a value, the least one or
    more where the review names one. Fields absent from ``df`` are not looked at.
    """
    kinds = dict(df.dtypes)
    entry = F.struct("field", "least", "reason")
    listed = reviews.groupBy(*[col(k).alias(f"_{k}") for k in KEYS]).agg(
        F.sort_array(F.collect_set(entry)).alias("_reviews")
    )
    match = F.lit(True)
    for k in KEYS:
        match = match & (col(k) == F.col(f"_{k}").cast(kinds[k]))
    numbers = [c for c, kind in kinds.items() if c in FIELDS and kind != "string"]

    def holds(review: Column) -> Column:
        test = F.lit(False)
        for c in numbers:
            value = F.nullif(col(c).cast("double"), F.lit(float(SENTINEL)))
            reached = review["least"].isNull() | (value >= review["least"])
            test = test | ((review["field"] == c) & value.isNotNull() & reached)
        return test

    reasons = F.transform(F.filter("_reviews", holds), lambda r: r["reason"])
    text = F.nullif(F.array_join(F.array_distinct(reasons), "; "), F.lit(""))
    return df.join(listed, match, "left").select(
        *[col(c) for c in df.columns],
        text.isNotNull().alias("review_flag"),
        text.alias("review_reasons"),
    )


def _wide(corrections: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row per lender, year and type: a factor, its least value and a set-missing mark per field."""
    if "above" not in corrections.columns:
        corrections = corrections.withColumn("above", F.lit(None).cast("double"))
    aggs = []
    for i, f in enumerate(fields):
        mine = F.col("field") == f
        aggs.append(F.product(F.when(mine, F.col("factor"))).alias(f"_factor{i}"))
        aggs.append(F.max(F.when(mine, F.col("above"))).alias(f"_above{i}"))
        aggs.append(F.bool_or(mine & F.col("factor").isNull()).alias(f"_missing{i}"))
    return corrections.groupBy(*[col(k).alias(f"_{k}") for k in KEYS]).agg(*aggs)


def correct(
    df: DataFrame,
    corrections: DataFrame | None = None,
    rules: Sequence[Rule] = (),
    fields: Sequence[str] = FIELDS,
) -> DataFrame:
    """Corrected values, ``corrections`` (what changed) and ``dq_flag``.

    A lender's own correction wins over a rule. Sentinels are never scaled. Whole
    number columns are rounded back to whole numbers.
    """
    kinds = dict(df.dtypes)
    chosen = [f for f in fields if f in kinds]
    source = df
    if corrections is not None:
        match = F.lit(True)
        for k in KEYS:
            match = match & (col(k) == F.col(f"_{k}").cast(kinds[k]))
        source = df.join(_wide(corrections, chosen), match, "left")
    new: dict[str, Column] = {}
    changes: list[Column] = []
    for i, f in enumerate(chosen):
        value = col(f)
        real = value.isNotNull() & (value != SENTINEL)
        scale, origin, gone = F.lit(None).cast("double"), F.lit(None).cast("string"), F.lit(False)
        for rule in rules:
            if rule.field == f:
                # a later rule sees what the earlier ones made of the value
                now = F.coalesce(value * scale, value)
                hit = real & (now > rule.above) & (now < rule.below)
                scale = F.when(hit, F.coalesce(scale, F.lit(1.0)) * F.lit(float(rule.factor))).otherwise(scale)
                origin = F.when(hit, F.lit("rule")).otherwise(origin)
        if corrections is not None:
            factor = F.col(f"_factor{i}")
            gone = F.coalesce(F.col(f"_missing{i}"), F.lit(False))
            above = F.col(f"_above{i}")
            known = real & factor.isNotNull() & (above.isNull() | (value > above))
            scale = F.when(known, factor).otherwise(scale)
            origin = F.when(gone | known, F.lit("lender")).otherwise(origin)
        scaled = value * scale
        if kinds[f] in ("bigint", "int", "smallint"):
            scaled = F.round(scaled, 0)
        fixed = F.when(gone, F.lit(None)).when(scale.isNotNull(), scaled.cast(kinds[f])).otherwise(value)
        new[f] = fixed
        entry = F.struct(
            F.lit(f).alias("field_name"),
            value.cast("double").alias("original_value"),
            fixed.cast("double").alias("corrected_value"),
            origin.alias("correction_type"),
        )
        changes.append(F.when(origin.isNotNull() & ~value.eqNullSafe(fixed), entry))
    log = F.array_compact(F.array(*changes))
    return source.select(
        *[new[c].alias(c) if c in new else col(c) for c in df.columns],
        log.alias("corrections"),
        (F.size(log) > 0).alias("dq_flag"),
    )


def correction_audit(
    corrected: DataFrame, key: str = INDEX_COLUMN, keep: Sequence[str] = (), at: str | None = None
) -> DataFrame:
    """One row per changed value. ``at`` fixes the time stamp of a run."""
    stamp = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    return corrected.filter("dq_flag").select(
        col(key), *[col(c) for c in keep], F.inline("corrections")
    ).withColumn("correction_timestamp", stamp)


def repeat_lenders(audit: DataFrame, min_years: int = 2) -> DataFrame:
    """Lenders with corrections in several years."""
    return (
        audit.groupBy("lei")
        .agg(
            F.count_distinct("activity_year").alias("years"),
            F.count(F.lit(1)).alias("corrections"),
        )
        .filter(F.col("years") >= min_years)
    )


PROFILE_PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)


def correction_profile(
    before: DataFrame, after: DataFrame, fields: Sequence[str], probs: Sequence[float] = PROFILE_PROBS
) -> DataFrame:
    """Exact quantiles of each field before and after; a few rows per field.

    Both stages are made once: their fields go into one narrow table, a column per field and
    stage, whose quantiles are searched together.
    """
    stages: Mapping[str, DataFrame] = {"before": before, "after": after}
    names = {(f, stage): f"{stage}_{i}" for stage in stages for i, f in enumerate(fields)}
    parts = [
        df.select(*[(col(f).cast("double") if own == stage else F.lit(None).cast("double")).alias(n) for (f, own), n in names.items()])
        for stage, df in stages.items()
    ]
    found = exact_quantiles(cut_lineage(reduce(DataFrame.unionAll, parts)), list(names.values()), probs)
    rows = [
        (f, stage, float(p), v)
        for stage in stages
        for f in fields
        for p, v in zip(probs, found[names[f, stage]], strict=True)
    ]
    schema = "field_name string, stage string, prob double, value double"
    return before.sparkSession.createDataFrame(rows, schema)
