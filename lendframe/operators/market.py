"""Market structure, lender performance and fair-lending measures.

Every measure aggregates loans to a small key first; joins and windows work on
those summaries only.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.casts import col
from ..session import cut_lineage

# Action codes.
ORIGINATED = 1
APPROVED = (1, 2)
DECIDED = (1, 2, 3)
APPLIED = (1, 2, 3, 4, 5)
NOT_SOLD = 0

MARKET = ("county_code", "activity_year")


def lender_volumes(loans: DataFrame, market: Sequence[str] = MARKET) -> DataFrame:
    return loans.groupBy(*[col(c) for c in market], col("lei")).agg(
        F.sum("loan_amount").alias("volume"), F.count(F.lit(1)).alias("loans")
    )


def hhi(volumes: DataFrame, market: Sequence[str] = MARKET) -> DataFrame:
    """Sum of squared percentage shares per market, 0 to 10,000."""
    v = F.col("volume").cast("double")
    return volumes.groupBy(*[col(c) for c in market]).agg(
        F.count("volume").alias("lenders"),
        (F.lit(10_000.0) * F.sum(v * v) / (F.sum(v) * F.sum(v))).alias("hhi"),
    )


def concentration_ratios(
    volumes: DataFrame, market: Sequence[str] = MARKET, sizes: Sequence[int] = (4, 8)
) -> DataFrame:
    """Share of the largest lenders per market: ``cr4``, ``cr8``."""
    keys = [col(c) for c in market]
    largest = W.partitionBy(*keys).orderBy(F.desc_nulls_last("volume"), "lei")
    ranked = volumes.withColumn("_rank", F.row_number().over(largest))
    top = ranked.filter(F.col("_rank") <= max(sizes)).groupBy(*keys).agg(
        *[F.sum(F.when(F.col("_rank") <= n, F.col("volume"))).alias(f"_top{n}") for n in sizes]
    )
    totals = volumes.groupBy(*[col(c).alias(f"_{c}") for c in market]).agg(
        F.sum("volume").alias("_total")
    )
    same = F.lit(True)
    for c in market:
        same = same & col(c).eqNullSafe(F.col(f"_{c}"))
    return top.join(totals, same).select(
        *keys, *[(F.col(f"_top{n}") / F.col("_total")).alias(f"cr{n}") for n in sizes]
    )


def share_change(
    volumes: DataFrame, place: Sequence[str] = ("county_code",), year_col: str = "activity_year"
) -> DataFrame:
    """Market share per lender and year, and its change since the lender's last year there."""
    market = [*place, year_col]
    totals = volumes.groupBy(*[col(c).alias(f"_{c}") for c in market]).agg(
        F.sum("volume").alias("_total")
    )
    same = F.lit(True)
    for c in market:
        same = same & col(c).eqNullSafe(F.col(f"_{c}"))
    shares = volumes.join(cut_lineage(totals), same).select(
        *[col(c) for c in market], "lei", (F.col("volume") / F.col("_total")).alias("share")
    )
    history = W.partitionBy(*[col(c) for c in place], F.col("lei")).orderBy(year_col)
    return shares.withColumn("change", F.col("share") - F.lag("share").over(history))


def origination_ratio(loans: DataFrame, measures: Sequence[str] = ()) -> DataFrame:
    """Originations per application and average loan characteristics by lender."""
    action = F.col("action_taken")
    made, asked = F.count_if(action == ORIGINATED), F.count_if(action.isin(*APPLIED))
    return loans.groupBy("lei").agg(
        asked.alias("applications"),
        made.alias("originations"),
        (made / F.nullif(asked, F.lit(0))).alias("origination_ratio"),
        *[F.avg(col(c)).alias(f"average_{c}") for c in measures],
    )


def entry_exit(loans: DataFrame, place: Sequence[str] = ("county_code",)) -> DataFrame:
    """First and last year of each lender in each market."""
    return loans.groupBy(*[col(c) for c in place], col("lei")).agg(
        F.min("activity_year").alias("entry_year"),
        F.max("activity_year").alias("exit_year"),
        F.count_distinct("activity_year").alias("active_years"),
    )


def volume_rollup(
    loans: DataFrame, levels: Sequence[str] = ("census_tract", "msa_md", "county_code", "state_code")
) -> DataFrame:
    """Loans and amounts per tract, metro area, county and state, one pass."""
    names = [c for c in levels if c in loans.columns]
    keys = [col(c) for c in names]
    grouped = loans.groupingSets([[k] for k in keys], *keys).agg(
        F.grouping_id().alias("_level"),
        F.count(F.lit(1)).alias("loans"),
        F.sum("loan_amount").alias("volume"),
    )
    # grouping_id has a zero bit for the one column kept, first column highest
    level, code = F, F.coalesce(*[col(c).cast("string") for c in names])
    for i, c in enumerate(names):
        level = level.when(F.col("_level") == (2 ** len(names) - 1) - 2 ** (len(names) - 1 - i), c)
    return grouped.select(level.alias("level"), code.alias("code"), "loans", "volume")


# Shares of a market, squared and summed, from which it counts as concentrated.
CONCENTRATED, HIGHLY_CONCENTRATED = 1000, 1800


def structure_report(volumes: DataFrame, place: Sequence[str] = ("county_code",), year_col: str = "activity_year") -> DataFrame:
    """One row per market and year: size, concentration, the largest lender, lenders that come and go.

    A lender comes in its first year in a place and goes in its last; lenders without volume
    count as such but have no share. Works on the volumes per market and lender alone.
    """
    market = [*[col(c) for c in place], col(year_col)]
    there = W.partitionBy(*[col(c) for c in place], F.col("lei"))
    largest = W.partitionBy(*market).orderBy(F.desc_nulls_last("volume"), "lei")
    v = F.coalesce(F.col("volume"), F.lit(0)).cast("double")
    marked = volumes.select(
        *market,
        "lei",
        "loans",
        v.alias("_v"),
        F.row_number().over(largest).alias("_rank"),
        (F.min(year_col).over(there) == col(year_col)).alias("_comes"),
        (F.max(year_col).over(there) == col(year_col)).alias("_goes"),
    )
    total = F.nullif(F.sum("_v"), F.lit(0.0))

    def top(n: int) -> Column:
        return F.sum(F.when(F.col("_rank") <= n, F.col("_v")).otherwise(0.0)) / total

    report = marked.groupBy(*market).agg(
        F.count(F.lit(1)).alias("lenders"),
        F.sum("loans").alias("loans"),
        F.sum("_v").alias("volume"),
        (10_000.0 * F.sum(F.col("_v") * F.col("_v")) / (total * total)).alias("hhi"),
        top(1).alias("cr1"),
        top(4).alias("cr4"),
        top(8).alias("cr8"),
        F.min(F.when(F.col("_rank") == 1, F.col("lei"))).alias("largest_lender"),
        F.count_if("_comes").alias("entries"),
        F.count_if("_goes").alias("exits"),
    )
    hhi_ = F.col("hhi")
    kind = F.when(hhi_ > HIGHLY_CONCENTRATED, "high").when(hhi_ >= CONCENTRATED, "moderate").when(hhi_.isNotNull(), "low")
    return report.withColumn("concentration", kind)


def lender_scorecard(loans: DataFrame, measures: Sequence[str] = (), place: str = "county_code") -> DataFrame:
    """One row per lender and year: activity, reach, market share and rank, with the change on the lender's year before.

    ``share`` is of the year's originated volume, ``rank`` by it, ``percentile`` the part of the year's
    lenders with less. Loans are aggregated once, by lender, year and place; all else works on
    the summary.
    """
    action = F.col("action_taken")
    made = action == ORIGINATED
    keys = [F.col("lei"), F.col("activity_year")]
    by_place = loans.groupBy(*keys, col(place).alias("_place")).agg(
        F.count_if(action.isin(*APPLIED)).alias("_asked"),
        F.count_if(made).alias("_made"),
        F.count_if(action.isin(*DECIDED)).alias("_decided"),
        F.count_if(action.isin(*APPROVED)).alias("_approved"),
        F.sum(F.when(made, F.col("loan_amount"))).alias("_volume"),
        *[x for c in measures for x in (F.sum(F.when(made, col(c))).alias(f"_sum_{c}"), F.count(F.when(made, col(c))).alias(f"_n_{c}"))],
    )
    cards = by_place.groupBy(*keys).agg(
        F.sum("_asked").alias("applications"),
        F.sum("_made").alias("originations"),
        (F.sum("_made") / F.nullif(F.sum("_asked"), F.lit(0))).alias("origination_ratio"),
        (F.sum("_approved") / F.nullif(F.sum("_decided"), F.lit(0))).alias("approval_rate"),
        F.count_if(F.col("_place").isNotNull() & (F.col("_made") > 0)).alias("markets"),
        F.coalesce(F.sum("_volume"), F.lit(0)).cast("bigint").alias("volume"),
        *[(F.sum(f"_sum_{c}") / F.nullif(F.sum(f"_n_{c}"), F.lit(0))).alias(f"average_{c}") for c in measures],
    )
    # one row per lender and year: the largest group is a year's lenders
    cards = cut_lineage(cards)
    totals = cards.groupBy(F.col("activity_year").alias("_year")).agg(F.sum("volume").alias("_total"))
    joined = cards.join(totals, F.col("activity_year").eqNullSafe(F.col("_year"))).drop("_year")
    year, history = W.partitionBy("activity_year"), W.partitionBy("lei").orderBy("activity_year")
    ranked = joined.withColumns(
        {
            "share": F.col("volume") / F.nullif(F.col("_total"), F.lit(0)),
            "rank": F.rank().over(year.orderBy(F.desc("volume"))),
            "percentile": F.percent_rank().over(year.orderBy("volume")),
        }
    ).drop("_total")
    return ranked.withColumns(
        {
            "share_change": F.col("share") - F.lag("share").over(history),
            "rank_change": F.col("rank") - F.lag("rank").over(history),
        }
    )


def disparate_impact(
    loans: DataFrame, group_col: str, reference: object, by: Sequence[str] = ("lei",)
) -> DataFrame:
    """Approval rate of each group over that of the reference group."""
    action = F.col("action_taken")
    rates = (
        loans.filter(action.isin(*DECIDED) & col(group_col).isNotNull())
        .groupBy(*[col(c) for c in by], col(group_col).alias("group"))
        .agg(
            F.count(F.lit(1)).alias("decisions"),
            F.avg(action.isin(*APPROVED).cast("double")).alias("approval_rate"),
        )
    )
    base = rates.filter(F.col("group") == F.lit(reference)).select(
        *[col(c).alias(f"_{c}") for c in by], F.col("approval_rate").alias("_rate")
    )
    same = F.lit(True)
    for c in by:
        same = same & col(c).eqNullSafe(F.col(f"_{c}"))
    ratio = F.col("approval_rate") / F.nullif(F.col("_rate"), F.lit(0.0))
    return rates.join(base, same, "left").select(
        *[col(c) for c in by], "group", "decisions", "approval_rate", ratio.alias("impact_ratio")
    )


def purchase_edges(loans: DataFrame) -> DataFrame:
    """Edges lender -> kind of purchaser, weighted by loans and amounts."""
    sold = F.col("purchaser_type") != NOT_SOLD
    return loans.filter(sold).groupBy("lei", "purchaser_type", "activity_year").agg(
        F.count(F.lit(1)).alias("loans"), F.sum("loan_amount").alias("volume")
    )


def volume_trend(
    loans: DataFrame, place: Sequence[str] = ("state_code",), year_col: str = "activity_year"
) -> DataFrame:
    """Yearly loans, amounts and rates per market, with the change on the year before."""
    keys = [col(c) for c in place]
    yearly = loans.groupBy(*keys, col(year_col)).agg(
        F.count(F.lit(1)).alias("loans"),
        F.sum("loan_amount").alias("volume"),
        F.avg("interest_rate").alias("average_rate"),
    )
    history = W.partitionBy(*keys).orderBy(year_col)
    return yearly.withColumns(
        {
            "loans_change": F.col("loans") - F.lag("loans").over(history),
            "rate_change": F.col("average_rate") - F.lag("average_rate").over(history),
        }
    )


def trend_slopes(
    trend: DataFrame, place: Sequence[str] = ("state_code",), year_col: str = "activity_year"
) -> DataFrame:
    """Least-squares slope per market over its years."""
    year = col(year_col).cast("double")
    return trend.groupBy(*[col(c) for c in place]).agg(
        F.count(F.lit(1)).alias("years"),
        F.regr_slope(F.col("loans").cast("double"), year).alias("loans_slope"),
        F.regr_slope(F.col("average_rate"), year).alias("rate_slope"),
    )


def lender_footprint(loans: DataFrame, min_share: float, place: str = "census_tract") -> DataFrame:
    """Places that hold at least ``min_share`` of a lender's originations."""
    made = loans.filter(F.col("action_taken") == ORIGINATED).groupBy("lei", place).agg(
        F.count(F.lit(1)).alias("_loans")
    )
    totals = made.groupBy(F.col("lei").alias("_lei")).agg(F.sum("_loans").alias("_total"))
    joined = made.join(totals, F.col("lei") == F.col("_lei"))
    return joined.filter(F.col("_loans") >= min_share * F.col("_total")).select("lei", place)


def assessment_ratio(loans: DataFrame, areas: DataFrame, place: str = "census_tract") -> DataFrame:
    """Share of each lender's originations inside its assessment area (lei, place)."""
    made = loans.filter(F.col("action_taken") == ORIGINATED).groupBy("lei", place).agg(
        F.count(F.lit(1)).alias("_loans")
    )
    area = areas.select(F.col("lei").alias("_lei"), col(place).alias("_place")).distinct()
    same = (F.col("lei") == F.col("_lei")) & (col(place) == F.col("_place"))
    inside = F.when(F.col("_place").isNotNull(), F.col("_loans")).otherwise(0)
    return (
        made.join(area, same, "left")
        .groupBy("lei")
        .agg(F.sum("_loans").alias("originations"), F.sum(inside).alias("inside"))
        .withColumn("inside_ratio", F.col("inside") / F.col("originations"))
    )


def rate_gap(
    loans: DataFrame,
    group_col: str,
    groups: tuple[object, object],
    outcome: str,
    covariates: Sequence[str],
) -> DataFrame:
    """Two-group decomposition of a mean gap into explained and unexplained parts.

    Explained is what the groups' different covariate means predict at the second
    group's least-squares coefficients. One pass gathers each group's means and
    covariances; only those few numbers are solved on the driver.
    """
    names = list(covariates)
    data = loans.filter(col(group_col).isin(*groups)).select(
        col(group_col).alias("_group"),
        *[col(c).cast("double").alias(c) for c in [outcome, *names]],
    ).na.drop()
    pairs = [(a, b) for i, a in enumerate(names) for b in [*names[i:], outcome]]
    rows = (
        data.groupBy("_group")
        .agg(
            *[F.avg(col(c)).alias(f"mean_{c}") for c in [outcome, *names]],
            *[F.covar_pop(col(a), col(b)).alias(f"cov_{a}_{b}") for a, b in pairs],
        )
        .collect()
    )
    stats = {r["_group"]: r for r in rows}
    first, second = stats[groups[0]], stats[groups[1]]
    spread = np.array(
        [[second[f"cov_{min(a, b, key=names.index)}_{max(a, b, key=names.index)}"] for b in names] for a in names]
    )
    slopes = np.linalg.lstsq(spread, [second[f"cov_{a}_{outcome}"] for a in names], rcond=None)[0]
    gap = first[f"mean_{outcome}"] - second[f"mean_{outcome}"]
    moves = [first[f"mean_{c}"] - second[f"mean_{c}"] for c in names]
    explained = float(np.dot(slopes, moves))
    schema = "group_a string, group_b string, gap double, explained double, unexplained double"
    row = (str(groups[0]), str(groups[1]), gap, explained, gap - explained)
    return loans.sparkSession.createDataFrame([row], schema)
