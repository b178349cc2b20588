"""Spark queries by name: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..eras import (
    DERIVED_COLUMNS,
    PERIOD_2007_2017,
    POST2018,
    POST2018_EXEMPT_COLUMNS,
    POST2018_TRACT_COLUMNS,
    PRE2007,
    Era,
)
from ..functions import codes
from ..functions.casts import code_text, col, to_double, to_whole
from ..operators import (
    cleaning,
    columns,
    corrections,
    decomposition,
    forest,
    harmonize,
    identity,
    lenders,
    market,
    neighbors,
    network,
    profiling,
    reporters,
    splits,
    tracts,
    vintages,
)
from ..plans import all_eras as era_view
from ..plans import clean
from ..session import shared_folder
from ..sources import delimited, layers, listing
from .views import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(value: Column) -> Column:
    """Six places, negative zero folded, as the SQL side does."""
    return F.round(value, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[r6(col(n)).alias(n) if kind == "double" else col(n) for n, kind in df.dtypes]
    )


def silver(spark: SparkSession, sf: str, name: str = "lar_raw") -> DataFrame:
    return harmonize.silver_post2018(view(spark, sf, name))


# --- one era end to end -------------------------------------------------------


@query
def county_counts(spark, sf):
    """Purchased loans in one district by year and county, best release of each year."""
    loans = silver(spark, sf).filter("state_code = 'DC' AND action_taken = 6")
    return vintages.best_county_counts(loans)


@query
def harmonize_post2018(spark, sf):
    return rounded(silver(spark, sf))


@query
def silver_post2018(spark, sf):
    wide = columns.drop_present(view(spark, sf, "lar_wide"), [*DERIVED_COLUMNS, *POST2018_TRACT_COLUMNS])
    return rounded(harmonize.silver_post2018(columns.dashes_to_underscores(wide)))


@query
def silver_2007_2017(spark, sf):
    return rounded(harmonize.silver_2007_2017(view(spark, sf, "lar_2007_2017"), "d"))


@query
def silver_pre2007(spark, sf):
    return rounded(harmonize.silver_pre2007(view(spark, sf, "lar_pre2007")))


def read_back(df: DataFrame, era: Era) -> DataFrame:
    """Through a partitioned silver table in the shared folder: written, written again, and read."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    for _ in range(2):
        layers.write_partitioned(df, path, era.partition_by)
    return layers.read_silver(df.sparkSession, path, era).select(*[col(c) for c in df.columns])


@query
def silver_rows_post2018(spark, sf):
    wide = columns.drop_present(view(spark, sf, "lar_wide"), [*DERIVED_COLUMNS, *POST2018_TRACT_COLUMNS])
    return rounded(read_back(harmonize.silver_post2018(columns.dashes_to_underscores(wide)), POST2018))


@query
def silver_rows_2007_2017(spark, sf):
    return rounded(read_back(harmonize.silver_2007_2017(view(spark, sf, "lar_2007_2017"), "d"), PERIOD_2007_2017))


@query
def silver_rows_pre2007(spark, sf):
    return rounded(read_back(harmonize.silver_pre2007(view(spark, sf, "lar_pre2007")), PRE2007))


@query
def text_scan(spark, sf):
    """Raw loans as pipe-delimited text and back, every column as text."""
    loans = view(spark, sf, "lar_raw")
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    plain = loans.write.option("sep", "|").option("header", True)
    plain.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return delimited.read_text_table(spark, path, "|", loans.columns)


@query
def clean_loans(spark, sf):
    loans = clean.clean_loans(
        view(spark, sf, "lar_wide"), True, "src_pos", crosswalk=view(spark, sf, "crosswalk")
    )
    return rounded(loans).select(
        "src_pos", "hmda_record_key", "census_tract", "county_code", "loan_amount", "dti", "ltv",
        "rate_spread", "income", "race", "sex", "outlier_interest_rate", "outlier_rate_spread",
        "_metadata_dedup_dropped", "_metadata_plausibility_dropped",
    )


@query
def clean_silver(spark, sf):
    """The cleaning job on typed loans: exempt values neither fail a bound nor enter a mean."""
    loans = clean.clean_loans(silver(spark, sf, "lar_wide"), True, "src_pos")
    return rounded(loans).select(
        "src_pos", "hmda_record_key", "loan_amount", "dti", "rate_spread", "outlier_interest_rate",
        "outlier_rate_spread", "_metadata_dedup_dropped", "_metadata_plausibility_dropped",
    )


@query
def all_eras(spark, sf):
    loans = era_view.all_eras(
        harmonize.silver_pre2007(view(spark, sf, "lar_pre2007")),
        harmonize.silver_2007_2017(view(spark, sf, "lar_2007_2017"), "d"),
        silver(spark, sf),
    )
    return loans.select(
        "era", "activity_year", "src_pos", "agency_code", "msa_md", "state_code", "county_code",
        "census_tract", "loan_amount", "income", "action_taken", "file_type",
    )


# --- column rules -------------------------------------------------------------


@query
def rename_legacy(spark, sf):
    return columns.rename_legacy(view(spark, sf, "lar_2007_2017"))


@query
def rename_alt(spark, sf):
    return columns.rename_alternate(view(spark, sf, "lar_wide")).select("src_pos", "msa_md", "loan_to_value_ratio")


@query
def drop_derived_tract(spark, sf):
    wide = view(spark, sf, "lar_wide").drop("derived_msa-md")
    return columns.drop_present(wide, [*DERIVED_COLUMNS, *POST2018_TRACT_COLUMNS])


@query
def panel_header_fix(spark, sf):
    return columns.fix_panel_headers(view(spark, sf, "panel_raw"))


@query
def concat_diagonal(spark, sf):
    old = view(spark, sf, "lar_pre2007").select("src_pos", "activity_year", "respondent_id", "occupancy")
    new = view(spark, sf, "lar_raw").select(
        "src_pos", F.col("activity_year").cast("bigint").alias("activity_year"), "lei"
    )
    return columns.concat_diagonal([old, new])


@query
def file_type_post2018(spark, sf):
    files = view(spark, sf, "source_files")
    return files.select("file_id", codes.file_type_post2018(F.col("file_name"), strict=False).alias("file_type"))


@query
def file_type_2007_2017(spark, sf):
    files = view(spark, sf, "source_files")
    return files.select("file_id", codes.file_type_2007_2017(F.col("file_name"), strict=False).alias("file_type"))


@query
def exempt_sentinel(spark, sf):
    loans = columns.rename_legacy(view(spark, sf, "lar_wide"))
    present = [c for c in POST2018_EXEMPT_COLUMNS if c in loans.columns]
    return loans.select("src_pos", *[harmonize.exempt_to_sentinel(col(c)).alias(c) for c in present])


@query
def units_bucket(spark, sf):
    return view(spark, sf, "lar_raw").select("src_pos", harmonize.units_code(F.col("total_units")).alias("total_units"))


@query
def age_bucket(spark, sf):
    return view(spark, sf, "lar_raw").select("src_pos", harmonize.age_code(F.col("applicant_age")).alias("applicant_age"))


@query
def age62_flag(spark, sf):
    flag = harmonize.age62_code(F.col("applicant_age_above_62"))
    return view(spark, sf, "lar_raw").select("src_pos", flag.alias("applicant_age_above_62"))


@query
def dti_bucket(spark, sf):
    code = harmonize.dti_code(F.col("debt_to_income_ratio"))
    return view(spark, sf, "lar_raw").select("src_pos", code.alias("debt_to_income_ratio"))


@query
def conforming_code(spark, sf):
    code = harmonize.conforming_code(F.col("conforming_loan_limit"))
    return view(spark, sf, "lar_raw").select("src_pos", code.alias("conforming_loan_limit"))


@query
def coerce_double(spark, sf):
    names = ["interest_rate", "rate_spread", "loan_amount", "debt_to_income_ratio"]
    return rounded(cleaning.coerce_double(view(spark, sf, "lar_raw"), names).select("src_pos", *names))


@query
def coerce_bigint(spark, sf):
    names = ["loan_amount", "county_code", "universal_loan_identifier", "loan_term"]
    return view(spark, sf, "lar_raw").select("src_pos", *[to_whole(F.col(c)).alias(c) for c in names])


@query
def scale_thousands(spark, sf):
    loans = harmonize.silver_2007_2017(view(spark, sf, "lar_2007_2017"))
    return loans.select("src_pos", "loan_amount", "income")


@query
def income_sentinel(spark, sf):
    return silver(spark, sf).select("src_pos", "income")


@query
def geo_post2018(spark, sf):
    loans = view(spark, sf, "lar_raw")
    return loans.select(
        "src_pos",
        code_text(F.col("census_tract"), 11).alias("census_tract"),
        code_text(F.col("county_code"), 5).alias("county_code"),
    )


@query
def geo_pre2018(spark, sf):
    loans = columns.rename_legacy(view(spark, sf, "lar_2007_2017"))
    return harmonize.geo_pre2018(loans).select("src_pos", "state_code", "county_code", "census_tract", "msa_md")


@query
def na_like(spark, sf):
    return cleaning.na_to_null(view(spark, sf, "lar_wide")).select(
        "src_pos", "income", "interest_rate", "census_tract", "derived_race", "applicant_age_above_62"
    )


@query
def standardize_schema(spark, sf):
    loans = cleaning.standardize_schema(view(spark, sf, "lar_raw"), True)
    return rounded(loans.select("src_pos", "loan_amount", "dti", "ltv", "rate_spread", "income"))


@query
def derived_demographics(spark, sf):
    return cleaning.missing_and_derived(view(spark, sf, "lar_wide"), True).select(
        "src_pos", "derived_race", "derived_sex", "race", "sex"
    )


@query
def clean_rate_spread(spark, sf):
    return cleaning.clean_rate_spread(view(spark, sf, "lar_raw")).select("src_pos", "rate_spread")


@query
def sentinel_null(spark, sf):
    names = ["income", "interest_rate", "debt_to_income_ratio"]
    return rounded(cleaning.sentinel_to_null(silver(spark, sf), names).select("src_pos", *names))


@query
def strip_blank(spark, sf):
    return lenders.strip_blank(view(spark, sf, "ts_raw"))


@query
def export_projection(spark, sf):
    wide = view(spark, sf, "lar_wide")
    labels = {"applicant_age": "Age of the applicant", "loan_amount": "Amount"}
    values = {"loan_type": {1: "conventional", 2: "insured"}, "loan_amount": {0: "none"}}
    kept = wide.select(
        "src_pos", "activity_year", "loan_type", "loan_amount", "derived_msa-md",
        "tract_minority_population_percent",
    )
    return columns.export_projection(kept, labels, values)


# --- identity -----------------------------------------------------------------


@query
def record_key(spark, sf):
    return identity.add_record_key(view(spark, sf, "lar_raw"), True).select("src_pos", "hmda_record_key")


@query
def record_key_pre2018(spark, sf):
    return identity.add_record_key(view(spark, sf, "lar_pre2007"), False).select("src_pos", "hmda_record_key")


def _dedup(spark, sf, keep, null_keys="keep"):
    keyed = identity.add_record_key(view(spark, sf, "lar_raw"), True)
    # what is written can't be pruned by a later select
    wanted = keyed.select("src_pos", "hmda_record_key", "loan_amount")
    return identity.deduplicate(wanted, "src_pos", keep, null_keys=null_keys)


@query
def dedup_last(spark, sf):
    return _dedup(spark, sf, "last")


@query
def dedup_first(spark, sf):
    return _dedup(spark, sf, "first")


@query
def dedup_none(spark, sf):
    return _dedup(spark, sf, "none")


@query
def dedup_last_null_collapsed(spark, sf):
    return _dedup(spark, sf, "last", "collapse")


@query
def row_key(spark, sf):
    loans = view(spark, sf, "lar_raw").select("src_pos", "activity_year", "file_type")
    return identity.add_index(loans, "src_pos")


# --- filters, joins, tracts ---------------------------------------------------


@query
def plausibility(spark, sf):
    loans = cleaning.standardize_schema(view(spark, sf, "lar_raw"), True)
    return cleaning.plausibility_filter(loans, {"loan_amount": (10_000, 500_000)}).select(
        "src_pos", "_metadata_plausibility_dropped"
    )


@query
def plausibility_literal(spark, sf):
    loans = cleaning.standardize_schema(view(spark, sf, "lar_raw"), True)
    bounds = {"loan_amount": (None, 500_000), "ltv": (60, None)}
    return cleaning.plausibility_filter(loans, bounds, literal=True).select(
        "src_pos", "_metadata_plausibility_dropped"
    )


@query
def exempt_membership(spark, sf):
    loans = view(spark, sf, "lar_wide")
    return loans.select("src_pos", reporters.exemption_count(loans).alias("CountExemptions"))


@query
def crosswalk_tract(spark, sf):
    loans = silver(spark, sf).select("src_pos", "activity_year", "census_tract")
    return cleaning.crosswalk_tract(loans, view(spark, sf, "crosswalk"))


@query
def tract_dimension(spark, sf):
    return rounded(tracts.split_tracts(view(spark, sf, "lar_wide"))[1])


@query
def tract_facts(spark, sf):
    facts, _ = tracts.split_tracts(view(spark, sf, "lar_wide"))
    return facts.drop("derived_msa-md")


@query
def latest_file_type(spark, sf):
    loans = view(spark, sf, "lar_raw").select("src_pos", "activity_year", "file_type")
    return vintages.best_releases(loans)


@query
def year_type_inventory(spark, sf):
    return vintages.release_inventory(view(spark, sf, "lar_raw"))


# --- lenders ------------------------------------------------------------------


def _lenders(spark, sf):
    panel = columns.fix_panel_headers(view(spark, sf, "panel_raw"))
    return lenders.lenders_post2018(panel, view(spark, sf, "ts_raw"))


@query
def lenders_post2018(spark, sf):
    return _lenders(spark, sf)


PANEL_HEADERS = {
    "activity_year": "Activity Year",
    "upper": "Respondent Identification Number",
    "respondent_name": "Respondent Name (Panel)",
    "topholder_name": "Parent Name (Panel)",
    "topholder_rssd": "Parent Identification Number",
    "agency_code": "Agency Code",
    "assets": "Assets",
}
TS_HEADERS = {
    "activity_year": "Activity Year ",
    "lei": " Respondent ID",
    "respondent_name": "Respondent Name",
    "agency_code": "Agency Code",
    "respondent_state": "Respondent State",
    "lar_count": "Lar Count",
}


@query
def lenders_2007_2017(spark, sf):
    panel = columns.rename_present(view(spark, sf, "panel_raw"), PANEL_HEADERS)
    ts = columns.rename_present(view(spark, sf, "ts_raw"), TS_HEADERS)
    ts = ts.withColumn("Respondent Name (Panel)", F.lit("x"))
    return lenders.lenders_2007_2017(panel, ts)


@query
def duplicate_lenders(spark, sf):
    return lenders.duplicate_keys(_lenders(spark, sf), ["activity_year", "lei"])


@query
def table_profile(spark, sf):
    return lenders.table_profile(_lenders(spark, sf), ["activity_year", "lei", "respondent_id"])


@query
def missing_years(spark, sf):
    return lenders.missing_years(_lenders(spark, sf), range(2015, 2027))


@query
def lenders_per_year(spark, sf):
    return lenders.lenders_per_year(_lenders(spark, sf))


# --- profiling ----------------------------------------------------------------


@query
def tabulate_values(spark, sf):
    return profiling.tabulate_values(view(spark, sf, "lar_raw"))


@query
def type_candidates(spark, sf):
    return profiling.type_candidates(profiling.tabulate_values(view(spark, sf, "lar_raw")))


@query
def top_values(spark, sf):
    return profiling.top_values(view(spark, sf, "lar_raw"), "debt_to_income_ratio", 10)


@query
def quantile_trim(spark, sf):
    loans = silver(spark, sf).filter("interest_rate > 0")
    return rounded(cleaning.quantile_trim(loans, "interest_rate").select("src_pos", "interest_rate"))


def _lender_averages(spark, sf):
    loans = silver(spark, sf).filter("action_taken = 1")
    names = ["income", "loan_amount", "interest_rate"]
    return reporters.lender_averages(cleaning.sentinel_to_null(loans, names), names)


@query
def lender_averages(spark, sf):
    return rounded(_lender_averages(spark, sf))


@query
def density_histogram(spark, sf):
    averages = _lender_averages(spark, sf).filter("measure = 'loan_amount'")
    trimmed = cleaning.quantile_trim(averages, "average_value")
    bins = profiling.density_histogram(trimmed, "average_value", ["activity_year"])
    return bins.select(
        "activity_year", "bin", r6(F.col("left_edge")).alias("left_edge"), "cnt",
        r6(F.col("density")).alias("density"),
    )


@query
def exempt_reporters(spark, sf):
    loans = columns.rename_legacy(view(spark, sf, "lar_wide")).filter("action_taken = '1'")
    return rounded(reporters.exempt_reporters(loans, key="src_pos"))


# --- outliers and models ------------------------------------------------------


@query
def outlier_zscore(spark, sf):
    flagged = cleaning.flag_outliers(view(spark, sf, "lar_raw"))
    return flagged.select("src_pos", "outlier_interest_rate", "outlier_rate_spread")


@query
def median_impute(spark, sf):
    names = ["income", "interest_rate", "debt_to_income_ratio"]
    loans = cleaning.sentinel_to_null(silver(spark, sf), names)
    return rounded(cleaning.median_impute(loans, names).select("src_pos", *names))


@query
def hash_split(spark, sf):
    return splits.hash_split(view(spark, sf, "lar_raw").select("src_pos"), "src_pos")


def _forest_scores(spark, sf):
    loans = silver(spark, sf, "lar_wide").filter("action_taken = 1")
    return forest.isolation_forest(loans, key="src_pos")


@query
def isolation_forest(spark, sf):
    return rounded(_forest_scores(spark, sf))


@query
def forest_lender_summary(spark, sf):
    return rounded(forest.lender_anomaly_summary(_forest_scores(spark, sf)))


@query
def forest_anomalous_loans(spark, sf):
    return rounded(forest.anomalous_loans(_forest_scores(spark, sf)))


def _margin_scores(spark, sf):
    """Centred scores from a z-score margin on income, so that SQL can follow."""
    loans = cleaning.sentinel_to_null(silver(spark, sf), ["income"]).na.drop(subset=["income"])
    stats = loans.agg(F.avg("income").alias("m"), F.stddev_samp("income").alias("s")).first()
    score = 0.1 * (0.9 - F.abs(F.col("income") - stats["m"]) / stats["s"])
    scored = loans.select("src_pos", "lei", score.alias("anomaly_score"))
    return scored.withColumn("anomaly", F.when(F.col("anomaly_score") < 0, -1).otherwise(1))


@query
def lender_anomaly_summary(spark, sf):
    return rounded(forest.lender_anomaly_summary(_margin_scores(spark, sf)))


@query
def anomalous_loans(spark, sf):
    return rounded(forest.anomalous_loans(_margin_scores(spark, sf)))


KNN_COLUMNS = list(neighbors.FEATURES)


@query
def knn_outlier(spark, sf):
    """The published sample: 30-year originations of one loan type."""
    loans = silver(spark, sf, "lar_wide").filter("action_taken = 1 AND loan_term = 360 AND loan_type = 1")
    scored = neighbors.knn_outliers(loans, KNN_COLUMNS, key="src_pos")
    return scored.select("src_pos", r6(F.col("knn_distance")).alias("knn_distance"), "outlier")


@query
def knn_outlier_all_loans(spark, sf):
    """All loans with a value in every feature."""
    scored = neighbors.knn_outliers(silver(spark, sf, "lar_wide"), KNN_COLUMNS, key="src_pos")
    return scored.select("src_pos", r6(F.col("knn_distance")).alias("knn_distance"), "outlier")


@query
def knn_include_self(spark, sf):
    """All loans, each counted as its own first neighbour."""
    scored = neighbors.knn_outliers(silver(spark, sf, "lar_wide"), KNN_COLUMNS, key="src_pos", include_self=True)
    return scored.select("src_pos", r6(F.col("knn_distance")).alias("knn_distance"), "outlier")


@query
def knn_outlier_pruned(spark, sf):
    """All loans again, flags alone, most rows ruled out by bounds from random buckets."""
    scored = neighbors.pruned_knn_outliers(silver(spark, sf, "lar_wide"), KNN_COLUMNS, key="src_pos")
    return scored.select("src_pos", "outlier")


# --- file listings ------------------------------------------------------------


@query
def sniff_delimiter(spark, sf):
    return codes.with_delimiter(view(spark, sf, "text_heads")).select("file_id", "delimiter")


@query
def route_files(spark, sf):
    return listing.route_files(view(spark, sf, "source_files").select("file_id", "file_name"))


def _transfer(spark, sf, mode):
    files = view(spark, sf, "source_files")
    remote = files.select("file_name", F.col("remote_size").alias("size"), F.col("remote_modified").alias("modified"))
    local = files.filter("local_size IS NOT NULL").select(
        "file_name", F.col("local_size").alias("size"), F.col("local_modified").alias("modified")
    )
    return listing.transfer_plan(remote, local, mode)


@query
def transfer_plan(spark, sf):
    return _transfer(spark, sf, "if_size_diff")


@query
def transfer_plan_newer(spark, sf):
    return _transfer(spark, sf, "if_newer")


@query
def pending_sources(spark, sf):
    files = view(spark, sf, "source_files").select("file_id", codes.normal_stem(F.col("file_name")).alias("source"), "local_size")
    written = files.filter("local_size IS NOT NULL").select("source")
    return listing.pending_sources(files.drop("local_size"), written)


@query
def year_series_coverage(spark, sf):
    files = view(spark, sf, "source_files").select(F.col("file_name").alias("path"))
    return listing.year_coverage(files, 2010, 2024, "public|nationwide")


# --- planned corrections ------------------------------------------------------

# Corrections for three fixture lenders.
FIXTURE_CORRECTIONS = [
    ("LEI00000000000000001", 2018, "a", "income", 0.001),
    ("LEI00000000000000001", 2018, "b", "interest_rate", 100.0),
    ("LEI00000000000000001", 2019, "a", "income", 0.001),
    ("LEI00000000000000002", 2021, "c", "loan_term", None),
    ("LEI00000000000000002", 2022, "b", "discount_points", None),
    ("LEI00000000000000003", 2023, "c", "loan_amount", 0.01),
]
CORRECTED = [
    "income", "interest_rate", "combined_loan_to_value_ratio", "loan_amount", "loan_term", "discount_points",
]


def _lender_corrections(spark):
    schema = "lei string, activity_year bigint, file_type string, field string, factor double"
    return spark.createDataFrame(FIXTURE_CORRECTIONS, schema)


def _corrected(spark, sf, known=True, rules=True):
    return corrections.correct(
        silver(spark, sf, "lar_units"),
        _lender_corrections(spark) if known else None,
        corrections.RULES if rules else (),
    )


@query
def lender_corrections(spark, sf):
    return rounded(_corrected(spark, sf, rules=False).select("src_pos", *CORRECTED, "dq_flag"))


@query
def rule_corrections(spark, sf):
    return rounded(_corrected(spark, sf, known=False).select("src_pos", *CORRECTED, "dq_flag"))


@query
def known_corrections(spark, sf):
    """The shipped table of lender corrections."""
    loans = silver(spark, sf, "lar_known")
    fixed = corrections.correct(loans, corrections.known_corrections(spark))
    return rounded(fixed.select("src_pos", *CORRECTED, "dq_flag"))


@query
def review_flags(spark, sf):
    loans = silver(spark, sf, "lar_known").select("src_pos", *corrections.KEYS, "loan_amount", "loan_term")
    return corrections.review_flags(loans, corrections.known_reviews(spark))


def _audit(spark, sf):
    keep = ["lei", "activity_year"]
    return corrections.correction_audit(_corrected(spark, sf), "src_pos", keep, at="2024-01-01")


@query
def correction_audit(spark, sf):
    return rounded(_audit(spark, sf).drop("correction_timestamp"))


@query
def repeat_lenders(spark, sf):
    return corrections.repeat_lenders(_audit(spark, sf))


@query
def correction_profile(spark, sf):
    fields = ["interest_rate", "loan_amount"]
    before = cleaning.sentinel_to_null(silver(spark, sf, "lar_units"), fields)
    after = cleaning.sentinel_to_null(_corrected(spark, sf), fields)
    return rounded(corrections.correction_profile(before, after, fields))


# --- planned market analyses --------------------------------------------------


def _volumes(spark, sf):
    return market.lender_volumes(silver(spark, sf))


@query
def hhi(spark, sf):
    return rounded(market.hhi(_volumes(spark, sf)))


@query
def concentration_ratio(spark, sf):
    return rounded(market.concentration_ratios(_volumes(spark, sf)))


@query
def share_change(spark, sf):
    return rounded(market.share_change(_volumes(spark, sf)))


@query
def origination_ratio(spark, sf):
    return rounded(market.origination_ratio(silver(spark, sf), ["loan_amount"]))


@query
def entry_exit(spark, sf):
    return market.entry_exit(silver(spark, sf))


@query
def volume_rollup(spark, sf):
    return market.volume_rollup(silver(spark, sf))


@query
def disparate_impact(spark, sf):
    return rounded(market.disparate_impact(silver(spark, sf), "applicant_age_above_62", 0))


@query
def purchase_edges(spark, sf):
    return market.purchase_edges(silver(spark, sf, "lar_wide"))


@query
def volume_trend(spark, sf):
    loans = cleaning.sentinel_to_null(silver(spark, sf), ["interest_rate"])
    return rounded(market.volume_trend(loans))


@query
def volume_slope(spark, sf):
    loans = cleaning.sentinel_to_null(silver(spark, sf), ["interest_rate"])
    return rounded(market.trend_slopes(market.volume_trend(loans)))


@query
def assessment_ratio(spark, sf):
    loans = silver(spark, sf)
    areas = market.lender_footprint(loans, 0.02, "county_code")
    return rounded(market.assessment_ratio(loans, areas, "county_code"))


@query
def rate_gap(spark, sf):
    loans = cleaning.sentinel_to_null(
        silver(spark, sf), ["interest_rate", "combined_loan_to_value_ratio"]
    )
    gap = market.rate_gap(
        loans, "applicant_age_above_62", (1, 0), "interest_rate", ["combined_loan_to_value_ratio"]
    )
    return rounded(gap)


@query
def structure_report(spark, sf):
    return rounded(market.structure_report(_volumes(spark, sf)))


@query
def lender_scorecard(spark, sf):
    loans = cleaning.sentinel_to_null(silver(spark, sf), ["interest_rate"])
    return rounded(market.lender_scorecard(loans, ["loan_amount", "interest_rate"]))


@query
def harmonize_traps(spark, sf):
    """Padded and signed numbers, exponents, words for numbers, codes too wide, numbers too large."""
    return rounded(silver(spark, sf, "lar_traps"))


@query
def rate_decomposition(spark, sf):
    """The same gap over three covariates, one of them a category of three levels."""
    fields = ["interest_rate", "combined_loan_to_value_ratio", "loan_amount"]
    loans = cleaning.sentinel_to_null(silver(spark, sf), fields)
    parts = decomposition.rate_decomposition(
        loans, "applicant_age_above_62", (1, 0), "interest_rate", ["combined_loan_to_value_ratio", "loan_amount"], ["file_type"]
    )
    return rounded(parts)


@query
def network_rank(spark, sf):
    """Lenders and counties by the loans they share."""
    edges = network.connection_edges(silver(spark, sf))
    return rounded(network.network_rank(edges, damping=0.6))


# --- over files: registered by their own module ------------------------------

from . import layer_queries  # noqa: E402, F401
