"""DuckDB counterparts of the Spark queries, written independently of them."""

from __future__ import annotations

from ..operators.corrections import KNOWN_CORRECTIONS, REVIEWS
from .views import with_views

ORACLES: dict[str, str] = {}


def whole(c: str, kind: str = "BIGINT") -> str:
    return f"TRY_CAST(CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+') THEN {c} END AS {kind})"


def real(c: str) -> str:
    pattern = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"TRY_CAST(CASE WHEN regexp_full_match({c}, '{pattern}') THEN {c} END AS DOUBLE)"


def code(c: str, width: int) -> str:
    return f"LPAD(CAST(CAST(TRUNC({real(c)}) AS BIGINT) AS VARCHAR), {width}, '0')"


def r6(expr: str) -> str:
    return f"(ROUND({expr}, 6) + 0.0)"


def exempt(c: str) -> str:
    return f"CASE WHEN {c} = 'Exempt' THEN '-99999' ELSE {c} END"


def case(c: str, pairs: dict[str, object]) -> str:
    whens = " ".join(
        f"WHEN '{k}' THEN {'NULL' if v is None else repr(str(v))}" for k, v in pairs.items()
    )
    return f"CASE {c} {whens} ELSE {c} END"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


UNITS = whole("(" + case("total_units", {"5-24": 5, "25-49": 6, "50-99": 7, "100-149": 8, ">149": 9}) + ")", "SMALLINT")
AGE = whole(
    "(" + case("applicant_age", {"<25": 1, "25-34": 2, "35-44": 3, "45-54": 4, "55-64": 5, "65-74": 6, ">74": 7}) + ")",
    "SMALLINT",
)
AGE62 = "CAST(CASE lower(applicant_age_above_62) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS SMALLINT)"
DTI = whole(
    "("
    + case("debt_to_income_ratio", {"<20%": 10, "20%-<30%": 20, "30%-<36%": 30, "50%-60%": 50, ">60%": 60, "Exempt": -99999})
    + ")"
)
CONFORMING = "CAST(CASE conforming_loan_limit WHEN 'NC' THEN 0 WHEN 'C' THEN 1 ELSE -99999 END AS BIGINT)"
INCOME = f"""CASE WHEN income = 'Exempt' THEN -99999 ELSE {whole("income")} * 1000 END"""


def post2018(name: str) -> str:
    """Typed columns of a 2018+ view as a table expression."""
    plain = {
        "src_pos": "src_pos",
        "activity_year": whole("activity_year"),
        "file_type": "file_type",
        "lei": "lei",
        "universal_loan_identifier": "universal_loan_identifier",
        "state_code": "state_code",
        "county_code": code("county_code", 5),
        "census_tract": code("census_tract", 11),
        "action_taken": whole("action_taken"),
        "loan_amount": whole("loan_amount"),
        "income": INCOME,
        "interest_rate": real(f"({exempt('interest_rate')})"),
        "rate_spread": real(f"({exempt('rate_spread')})"),
        "combined_loan_to_value_ratio": real(f"({exempt('loan_to_value_ratio')})"),
        "debt_to_income_ratio": DTI,
        "total_units": UNITS,
        "applicant_age": AGE,
        "applicant_age_above_62": AGE62,
        "conforming_loan_limit": CONFORMING,
        "loan_term": whole(f"({exempt('loan_term')})"),
    }
    if name == "lar_wide":
        plain |= {
            "purchaser_type": whole("purchaser_type"),
            "loan_type": whole("loan_type"),
            "loan_purpose": whole("loan_purpose"),
            "property_value": whole(f"({exempt('property_value')})"),
            "discount_points": real(f"({exempt('discount_points')})"),
            "lender_credits": real(f"({exempt('lender_credits')})"),
            "reverse_mortgage": whole("reverse_mortgage"),
            "aus_1": whole("aus_1"),
            "derived_msa_md": whole('"derived_msa-md"'),
        }
    body = ", ".join(f"{e} AS {n}" for n, e in plain.items())
    return f"(SELECT {body} FROM {name})"


LOANS = post2018("lar_raw")
WIDE = post2018("lar_wide")


def rows_of(rows: tuple[tuple, ...]) -> str:
    """Rows of constants for VALUES."""
    return ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in row) + ")" for row in rows)


def put(name: str, views: str | tuple[str, ...], body: str, more: str = "") -> None:
    """Register ``body``; ``more`` adds table expressions after the views."""
    views = (views,) if isinstance(views, str) else views
    extra = f", {more}" if more else ""
    ORACLES[name] = with_views(views, f"{extra} {body}")


DOUBLES = ("interest_rate", "rate_spread", "combined_loan_to_value_ratio", "discount_points", "lender_credits")


def rounded_star(doubles: tuple[str, ...]) -> str:
    return "* REPLACE (" + ", ".join(f"{r6(d)} AS {d}" for d in doubles) + ")"


# --- one era end to end -------------------------------------------------------

put(
    "county_counts",
    "lar_raw",
    f"""SELECT activity_year, state_code, county_code, COUNT(*) AS "count"
    FROM (SELECT *, MIN(file_type) OVER (PARTITION BY activity_year) AS m
          FROM {LOANS} WHERE state_code = 'DC' AND action_taken = 6) x
    WHERE m = file_type GROUP BY activity_year, state_code, county_code""",
)
put("harmonize_post2018", "lar_raw", f"SELECT {rounded_star(DOUBLES[:3])} FROM {LOANS} x")
put("silver_post2018", "lar_wide", f"SELECT {rounded_star(DOUBLES)} FROM {WIDE} x")


def geo(state: str, county: str, tract: str, msa: str) -> str:
    s = f"LPAD(CAST({whole(state)} AS VARCHAR), 2, '0')"
    c = f"LPAD(CAST({whole(county)} AS VARCHAR), 3, '0')"
    t = f"LPAD(CAST(CAST(ROUND({real(tract)} * 100) AS BIGINT) AS VARCHAR), 6, '0')"
    return f"{s} AS state_code, {s} || {c} AS county_code, {s} || {c} || {t} AS census_tract, {code(msa, 5)} AS msa_md"


OLD_GEO = geo("state_code", "county_code", "census_tract_number", "msamd")
MIDDLE = f"""(SELECT src_pos, {whole("as_of_year")} AS activity_year, respondent_id,
    {whole("agency_code")} AS agency_code, {whole("sequence_number")} AS sequence_number, {OLD_GEO},
    {whole("loan_amount_000s")} * 1000 AS loan_amount, {whole("applicant_income_000s")} * 1000 AS income,
    {whole("owner_occupancy")} AS occupancy_type, {whole("action_taken")} AS action_taken,
    {r6(real("rate_spread"))} AS rate_spread, 'd' AS file_type FROM lar_2007_2017)"""
OLD = f"""(SELECT src_pos, {whole("activity_year")} AS activity_year, respondent_id, agency_code,
    {whole("sequence_number")} AS sequence_number, {geo("state_code", "county_code", "census_tract", "msamd")},
    {whole("loan_amount")} * 1000 AS loan_amount, {whole("income")} * 1000 AS income,
    {whole("occupancy")} AS occupancy_type, {whole("applicant_sex")} AS applicant_sex,
    {whole("edit_status")} AS edit_status FROM lar_pre2007)"""
put("silver_2007_2017", "lar_2007_2017", f"SELECT * FROM {MIDDLE} x")
put("silver_pre2007", "lar_pre2007", f"SELECT * FROM {OLD} x")
put("silver_rows_post2018", "lar_wide", f"SELECT {rounded_star(DOUBLES)} FROM {WIDE} x")
put("silver_rows_2007_2017", "lar_2007_2017", f"SELECT * FROM {MIDDLE} x")
put("silver_rows_pre2007", "lar_pre2007", f"SELECT * FROM {OLD} x")
put("text_scan", "lar_raw", "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM lar_raw")


def na(c: str, words: str = "'NA', 'N/A', 'Exempt', 'Not Applicable'") -> str:
    return f"CASE WHEN {c} IN ({words}) THEN NULL ELSE {c} END"


KEY = "TRIM(lei) || '||' || TRIM(universal_loan_identifier)"
put(
    "clean_loans",
    ("lar_wide", "crosswalk"),
    f"""SELECT src_pos, hmda_record_key, census_tract, county_code, {r6("loan_amount")} AS loan_amount,
      {r6("dti")} AS dti, {r6("ltv")} AS ltv, {r6("rate_spread")} AS rate_spread, income, race, sex,
      ABS({real("interest_rate")} - mi) > 6 * si AS outlier_interest_rate,
      ABS(rate_spread - mr) > 6 * sr AS outlier_rate_spread,
      CAST(dd AS BIGINT) AS _metadata_dedup_dropped, CAST(pd AS BIGINT) AS _metadata_plausibility_dropped
    FROM spread, (SELECT AVG({real("interest_rate")}) mi, STDDEV_SAMP({real("interest_rate")}) si,
        AVG(rate_spread) mr, STDDEV_SAMP(rate_spread) sr FROM spread) st,
      (SELECT (SELECT COUNT(*) FROM keyed) - (SELECT COUNT(*) FROM uniq) AS dd) d1,
      (SELECT (SELECT COUNT(*) FROM mapped) - (SELECT COUNT(*) FROM spread) AS pd) d2""",
    f"""keyed AS (SELECT *, {KEY} AS hmda_record_key FROM lar_wide),
    uniq AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hmda_record_key ORDER BY src_pos DESC) AS rn FROM keyed) x
      WHERE rn = 1 OR hmda_record_key IS NULL),
    mapped AS (SELECT src_pos, hmda_record_key, COALESCE(tract_2020, {na("census_tract")}) AS census_tract,
        {na("county_code")} AS county_code, {real("loan_amount")} AS loan_amount, {real("debt_to_income_ratio")} AS dti,
        {real("loan_to_value_ratio")} AS ltv, {real("rate_spread")} AS rate_spread, {na("income")} AS income,
        {na("derived_race")} AS race, {na("derived_sex")} AS sex, {na("interest_rate")} AS interest_rate
      FROM uniq LEFT JOIN (SELECT * FROM crosswalk WHERE target_year = 2020) c ON {na("census_tract")} = tract_src),
    spread AS (SELECT * REPLACE (CASE WHEN ABS(rate_spread) > 20 THEN NULL ELSE rate_spread END AS rate_spread) FROM mapped
      WHERE (ltv IS NULL OR ltv BETWEEN 0 AND 200) AND (dti IS NULL OR dti BETWEEN 0 AND 250)
        AND (loan_amount IS NULL OR loan_amount BETWEEN 0 AND 1500000))""",
)
put(
    "clean_silver",
    "lar_wide",
    f"""SELECT src_pos, hmda_record_key, {r6("loan_amount")} AS loan_amount, {r6("dti")} AS dti,
      {r6("rate_spread")} AS rate_spread, ABS(interest_rate - mi) > 6 * si AS outlier_interest_rate,
      ABS(rate_spread - mr) > 6 * sr AS outlier_rate_spread,
      CAST(dd AS BIGINT) AS _metadata_dedup_dropped, CAST(pd AS BIGINT) AS _metadata_plausibility_dropped
    FROM spread, (SELECT AVG(interest_rate) mi, STDDEV_SAMP(interest_rate) si, AVG(rate_spread) mr, STDDEV_SAMP(rate_spread) sr FROM spread) st,
      (SELECT (SELECT COUNT(*) FROM keyed) - (SELECT COUNT(*) FROM uniq) AS dd) d1,
      (SELECT (SELECT COUNT(*) FROM uniq) - (SELECT COUNT(*) FROM spread) AS pd) d2""",
    f"""keyed AS (SELECT *, {KEY} AS hmda_record_key FROM {WIDE} x),
    uniq AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY hmda_record_key ORDER BY src_pos DESC) AS rn FROM keyed) x
      WHERE rn = 1 OR hmda_record_key IS NULL),
    typed AS (SELECT src_pos, hmda_record_key, CAST(loan_amount AS DOUBLE) AS loan_amount,
        CAST(NULLIF(debt_to_income_ratio, -99999) AS DOUBLE) AS dti,
        NULLIF(rate_spread, -99999) AS rate_spread, NULLIF(interest_rate, -99999) AS interest_rate FROM uniq),
    spread AS (SELECT * REPLACE (CASE WHEN ABS(rate_spread) > 20 THEN NULL ELSE rate_spread END AS rate_spread) FROM typed
      WHERE (dti IS NULL OR dti BETWEEN 0 AND 250)
        AND (loan_amount IS NULL OR loan_amount BETWEEN 0 AND 1500000))""",
)
SHARED = "state_code, county_code, census_tract, loan_amount, income"
put(
    "all_eras",
    ("lar_pre2007", "lar_2007_2017", "lar_raw"),
    f"""SELECT 'pre2007' AS era, activity_year, src_pos, agency_code, msa_md, {SHARED},
      CAST(NULL AS BIGINT) AS action_taken, CAST(NULL AS VARCHAR) AS file_type FROM {OLD} a
    UNION ALL SELECT 'period_2007_2017', activity_year, src_pos, CAST(agency_code AS VARCHAR), msa_md, {SHARED}, action_taken, file_type FROM {MIDDLE} b
    UNION ALL SELECT 'post2018', activity_year, src_pos, NULL, NULL, {SHARED}, action_taken, file_type FROM {LOANS} c""",
)

# --- column rules -------------------------------------------------------------

put(
    "rename_legacy",
    "lar_2007_2017",
    """SELECT src_pos, as_of_year AS activity_year, respondent_id, agency_code, sequence_number, state_code, county_code,
      census_tract_number AS census_tract, msamd AS msa_md, loan_amount_000s AS loan_amount, applicant_income_000s AS income,
      owner_occupancy AS occupancy_type, action_taken, rate_spread, population AS tract_population, derived_race FROM lar_2007_2017""",
)
put("rename_alt", "lar_wide", 'SELECT src_pos, "derived_msa-md" AS msa_md, loan_to_value_ratio FROM lar_wide')
put(
    "drop_derived_tract",
    "lar_wide",
    """SELECT * EXCLUDE (derived_race, derived_sex, tract_population, tract_minority_population_percent, "derived_msa-md") FROM lar_wide""",
)
put(
    "panel_header_fix",
    "panel_raw",
    """SELECT activity_year, upper AS lei, respondent_name, topholder_name AS top_holder_name,
      topholder_rssd AS top_holder_rssd, agency_code, assets FROM panel_raw""",
)
put(
    "concat_diagonal",
    ("lar_pre2007", "lar_raw"),
    """SELECT src_pos, activity_year, respondent_id, occupancy, CAST(NULL AS VARCHAR) AS lei FROM lar_pre2007
    UNION ALL SELECT src_pos, activity_year, NULL, NULL, lei FROM lar_raw""",
)


def first_of(pairs: list[tuple[str, str]], otherwise: str = "NULL") -> str:
    whens = " ".join(f"WHEN regexp_matches(lower(file_name), '{p}') THEN '{v}'" for p, v in pairs)
    return f"CASE {whens} ELSE {otherwise} END"


put(
    "file_type_post2018",
    "source_files",
    "SELECT file_id, "
    + first_of([("three_year", "a"), ("one_year", "b"), ("public_(lar|panel|ts)", "c"), ("mlar", "e")])
    + " AS file_type FROM source_files",
)
put(
    "file_type_2007_2017",
    "source_files",
    "SELECT file_id, "
    + first_of([("three_year", "a"), ("one_year", "b"), ("public_lar", "c"), ("nationwide", "d"), ("mlar", "e")])
    + " AS file_type FROM source_files",
)
put(
    "exempt_sentinel",
    "lar_wide",
    "SELECT src_pos, "
    + ", ".join(
        f"{exempt(s)} AS {n}"
        for s, n in [
            ("loan_to_value_ratio", "combined_loan_to_value_ratio"),
            *[(c, c) for c in ("interest_rate", "rate_spread", "loan_term", "income", "property_value", "discount_points", "lender_credits")],
        ]
    )
    + " FROM lar_wide",
)
for rule, column, expr in (
    ("units_bucket", "total_units", UNITS),
    ("age_bucket", "applicant_age", AGE),
    ("age62_flag", "applicant_age_above_62", AGE62),
    ("dti_bucket", "debt_to_income_ratio", DTI),
    ("conforming_code", "conforming_loan_limit", CONFORMING),
    ("income_sentinel", "income", INCOME),
):
    put(rule, "lar_raw", f"SELECT src_pos, {expr} AS {column} FROM lar_raw")
put(
    "coerce_double",
    "lar_raw",
    "SELECT src_pos, "
    + ", ".join(f"{r6(real(c))} AS {c}" for c in ("interest_rate", "rate_spread", "loan_amount", "debt_to_income_ratio"))
    + " FROM lar_raw",
)
put(
    "coerce_bigint",
    "lar_raw",
    "SELECT src_pos, "
    + ", ".join(f"{whole(c)} AS {c}" for c in ("loan_amount", "county_code", "universal_loan_identifier", "loan_term"))
    + " FROM lar_raw",
)
put("scale_thousands", "lar_2007_2017", f"SELECT src_pos, loan_amount, income FROM {MIDDLE} x")
put(
    "geo_post2018",
    "lar_raw",
    f"SELECT src_pos, {code('census_tract', 11)} AS census_tract, {code('county_code', 5)} AS county_code FROM lar_raw",
)
put("geo_pre2018", "lar_2007_2017", f"SELECT src_pos, {OLD_GEO} FROM lar_2007_2017")
ALL_NA = "'NA', 'N/A', 'Exempt', 'Not Applicable', 'NA   ', 'nan'"
put(
    "na_like",
    "lar_wide",
    "SELECT src_pos, "
    + ", ".join(
        f"{na(c, ALL_NA)} AS {c}"
        for c in ("income", "interest_rate", "census_tract", "derived_race", "applicant_age_above_62")
    )
    + " FROM lar_wide",
)
put(
    "standardize_schema",
    "lar_raw",
    f"""SELECT src_pos, {r6(real("loan_amount"))} AS loan_amount, {r6(real("debt_to_income_ratio"))} AS dti,
      {r6(real("loan_to_value_ratio"))} AS ltv, {r6(real("rate_spread"))} AS rate_spread, income FROM lar_raw""",
)
put(
    "derived_demographics",
    "lar_wide",
    f"""SELECT src_pos, {na("derived_race")} AS derived_race, {na("derived_sex")} AS derived_sex,
      {na("derived_race")} AS race, {na("derived_sex")} AS sex FROM lar_wide""",
)
put(
    "clean_rate_spread",
    "lar_raw",
    f"""SELECT src_pos, CASE WHEN ABS({real("rate_spread")}) > 20 THEN NULL ELSE {real("rate_spread")} END AS rate_spread FROM lar_raw""",
)
put(
    "sentinel_null",
    "lar_raw",
    f"""SELECT src_pos, NULLIF(income, -99999) AS income, {r6("NULLIF(interest_rate, -99999)")} AS interest_rate,
      NULLIF(debt_to_income_ratio, -99999) AS debt_to_income_ratio FROM {LOANS} x""",
)
put(
    "strip_blank",
    "ts_raw",
    "SELECT "
    + ", ".join(
        f"NULLIF(TRIM({c}), '') AS {c}"
        for c in ("activity_year", "lei", "respondent_name", "agency_code", "respondent_state", "lar_count")
    )
    + " FROM ts_raw",
)
put(
    "export_projection",
    "lar_wide",
    """SELECT src_pos, CAST(activity_year AS SMALLINT) AS activity_year, CAST(loan_type AS SMALLINT) AS loan_type, loan_amount,
      "derived_msa-md" AS derived_msa_md, tract_minority_population_percent AS tract_minority_population_percen FROM lar_wide""",
)

# --- identity -----------------------------------------------------------------

put("record_key", "lar_raw", f"SELECT src_pos, {KEY} AS hmda_record_key FROM lar_raw")
put(
    "record_key_pre2018",
    "lar_pre2007",
    "SELECT src_pos, TRIM(respondent_id) || '||' || TRIM(agency_code) || '||' || TRIM(sequence_number) AS hmda_record_key FROM lar_pre2007",
)


def dedup(order: str, keep: str) -> str:
    return f"""SELECT src_pos, hmda_record_key, loan_amount,
      CAST((SELECT COUNT(*) FROM keyed) - COUNT(*) OVER () AS BIGINT) AS _metadata_dedup_dropped
    FROM (SELECT src_pos, {KEY} AS hmda_record_key, loan_amount,
      ROW_NUMBER() OVER (PARTITION BY {KEY} ORDER BY src_pos {order}) AS rn, COUNT(*) OVER (PARTITION BY {KEY}) AS n FROM lar_raw) x
    WHERE {keep}"""


KEYED = f"keyed AS (SELECT src_pos, {KEY} AS k FROM lar_raw)"
put("dedup_last", "lar_raw", dedup("DESC", "rn = 1 OR hmda_record_key IS NULL"), KEYED)
put("dedup_first", "lar_raw", dedup("ASC", "rn = 1 OR hmda_record_key IS NULL"), KEYED)
put("dedup_none", "lar_raw", dedup("ASC", "n = 1 OR hmda_record_key IS NULL"), KEYED)
put("dedup_last_null_collapsed", "lar_raw", dedup("DESC", "rn = 1"), KEYED)
put(
    "row_key",
    "lar_raw",
    """SELECT src_pos, activity_year, file_type, activity_year || file_type || '_' ||
      LPAD(CAST(ROW_NUMBER() OVER (PARTITION BY activity_year, file_type ORDER BY src_pos) - 1 AS VARCHAR), 9, '0') AS "HMDAIndex"
    FROM lar_raw""",
)

# --- filters, joins, tracts ---------------------------------------------------


def bounded(test: str) -> str:
    return f"""SELECT src_pos, CAST((SELECT COUNT(*) FROM lar_raw) - COUNT(*) OVER () AS BIGINT) AS _metadata_plausibility_dropped
    FROM (SELECT src_pos, {real("loan_amount")} AS amount, {real("debt_to_income_ratio")} AS dti,
      {real("loan_to_value_ratio")} AS ltv FROM lar_raw) x WHERE {test}"""


put(
    "plausibility",
    "lar_raw",
    bounded(
        """(ltv IS NULL OR ltv BETWEEN 0 AND 200) AND (dti IS NULL OR dti BETWEEN 0 AND 250)
        AND (amount IS NULL OR amount BETWEEN 10000 AND 500000)"""
    ),
)
put(
    "plausibility_literal",
    "lar_raw",
    bounded(
        """(ltv IS NULL OR ltv >= 60) AND (dti IS NULL OR dti >= 0 OR dti <= 250) AND (amount IS NULL OR amount <= 500000)"""
    ),
)
EXEMPT_ALL = (
    "reverse_mortgage", "debt_to_income_ratio", "interest_rate", "property_value", "rate_spread",
    "loan_term", "discount_points", "lender_credits", "aus_1",
)


def exempt_total(names: tuple[str, ...]) -> str:
    return " + ".join(f"CASE WHEN {c} IN ('1111', 'Exempt') THEN 1 ELSE 0 END" for c in names)


put("exempt_membership", "lar_wide", f'SELECT src_pos, CAST({exempt_total(EXEMPT_ALL)} AS BIGINT) AS "CountExemptions" FROM lar_wide')
put(
    "crosswalk_tract",
    ("lar_raw", "crosswalk"),
    f"""SELECT src_pos, activity_year, COALESCE(tract_2020, census_tract) AS census_tract FROM {LOANS} x
    LEFT JOIN (SELECT * FROM crosswalk WHERE target_year = 2020) c ON census_tract = tract_src""",
)
put(
    "tract_dimension",
    "lar_wide",
    f"""SELECT DISTINCT activity_year, census_tract, {r6(real("tract_population"))} AS tract_population,
      {r6(real("tract_minority_population_percent"))} AS tract_minority_population_percent FROM lar_wide""",
)
put(
    "tract_facts",
    "lar_wide",
    'SELECT * EXCLUDE (tract_population, tract_minority_population_percent, "derived_msa-md") FROM lar_wide',
)
put(
    "latest_file_type",
    "lar_raw",
    """SELECT src_pos, activity_year, file_type FROM (SELECT *, MIN(file_type) OVER (PARTITION BY activity_year) AS m FROM lar_raw) x
    WHERE m = file_type""",
)
put("year_type_inventory", "lar_raw", "SELECT DISTINCT activity_year, file_type FROM lar_raw")

# --- lenders ------------------------------------------------------------------

COMBINED = """combined AS (SELECT COALESCE(p.activity_year, t.activity_year) AS activity_year, COALESCE(p.upper, t.lei) AS lei,
    p.respondent_name AS respondent_name_panel, p.topholder_name AS top_holder_name, p.topholder_rssd AS top_holder_rssd,
    p.agency_code AS agency_code_panel, p.assets, t.respondent_name AS respondent_name_ts, t.agency_code AS agency_code_ts,
    t.respondent_state, t.lar_count
  FROM panel_raw p FULL OUTER JOIN ts_raw t
    ON p.activity_year IS NOT DISTINCT FROM t.activity_year AND p.upper IS NOT DISTINCT FROM t.lei)"""
BOTH = ("panel_raw", "ts_raw")
put("lenders_post2018", BOTH, "SELECT * FROM combined", COMBINED)
put(
    "lenders_2007_2017",
    BOTH,
    """SELECT NULLIF(TRIM(COALESCE(p.activity_year, t.activity_year)), '') AS "Activity Year",
      NULLIF(TRIM(COALESCE(p.upper, t.lei)), '') AS "Respondent ID",
      NULLIF(TRIM(COALESCE(p.agency_code, t.agency_code)), '') AS "Agency Code",
      NULLIF(TRIM(p.respondent_name), '') AS "Respondent Name Panel", NULLIF(TRIM(t.respondent_name), '') AS "Respondent Name TS",
      NULLIF(TRIM(p.topholder_name), '') AS "Parent Name", NULLIF(TRIM(p.topholder_rssd), '') AS "Parent Respondent ID",
      NULLIF(TRIM(p.assets), '') AS "Assets", NULLIF(TRIM(t.respondent_state), '') AS "Respondent State",
      NULLIF(TRIM(t.lar_count), '') AS "Lar Count"
    FROM panel_raw p FULL OUTER JOIN ts_raw t ON p.activity_year IS NOT DISTINCT FROM t.activity_year
      AND p.upper IS NOT DISTINCT FROM t.lei AND p.agency_code IS NOT DISTINCT FROM t.agency_code""",
)
put(
    "duplicate_lenders",
    BOTH,
    "SELECT COUNT(*) AS duplicate_keys FROM (SELECT activity_year, lei FROM combined GROUP BY 1, 2 HAVING COUNT(*) > 1) x",
    COMBINED,
)
put(
    "table_profile",
    BOTH,
    """SELECT COUNT(*) AS "rows", CAST(11 AS BIGINT) AS "columns", 'respondent_id' AS missing_key_columns FROM combined""",
    COMBINED,
)
put(
    "missing_years",
    BOTH,
    """SELECT y AS missing_year FROM range(2015, 2027) t(y)
    WHERE y NOT IN (SELECT TRY_CAST(activity_year AS BIGINT) FROM combined WHERE activity_year IS NOT NULL)""",
    COMBINED,
)
put("lenders_per_year", BOTH, "SELECT activity_year, COUNT(*) AS lender_count FROM combined GROUP BY 1", COMBINED)

# --- profiling ----------------------------------------------------------------

RAW_COLUMNS = (
    "src_pos", "activity_year", "file_type", "lei", "universal_loan_identifier", "state_code", "county_code",
    "census_tract", "action_taken", "loan_amount", "income", "interest_rate", "debt_to_income_ratio", "total_units",
    "applicant_age", "applicant_age_above_62", "conforming_loan_limit", "loan_term",
)
TABULATED = (
    "tabulated AS (SELECT * FROM (SELECT column_name, value, cnt, CAST(ROW_NUMBER() OVER (PARTITION BY column_name "
    "ORDER BY cnt DESC, value ASC NULLS LAST) AS INTEGER) AS rank FROM ("
    + union(
        [
            f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS cnt FROM lar_raw GROUP BY 2"
            for c in RAW_COLUMNS
        ]
    )
    + ") u) r WHERE rank <= 50)"
)
put("tabulate_values", "lar_raw", "SELECT column_name, value, cnt, rank FROM tabulated", TABULATED)
BARE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(value, '^-+', ''), '\\.', ''), 'e', ''), 'E', ''), '\\+', '')"
ODD = "NOT regexp_full_match(regexp_replace(regexp_replace(value, '^-+', ''), '\\.', ''), '[0-9]+')"
put(
    "type_candidates",
    "lar_raw",
    f"""SELECT column_name, COUNT(*) AS n_values, CAST(SUM(cnt) AS BIGINT) AS n_rows,
      CASE WHEN BOOL_AND(regexp_full_match(value, '-*[0-9]+')) THEN 'integer'
        WHEN BOOL_AND(regexp_full_match({BARE}, '[0-9]+')) THEN 'float' WHEN COUNT(value) > 0 THEN 'mixed' END AS candidate,
      COALESCE(array_to_string(list_slice(list(value ORDER BY rank) FILTER (value IS NOT NULL AND {ODD}), 1, 5), ', '), '') AS examples
    FROM tabulated GROUP BY column_name""",
    TABULATED,
)
put(
    "top_values",
    "lar_raw",
    "SELECT debt_to_income_ratio, COUNT(*) AS cnt FROM lar_raw GROUP BY 1 ORDER BY cnt DESC, 1 ASC NULLS LAST LIMIT 10",
)
put(
    "quantile_trim",
    "lar_raw",
    f"""SELECT src_pos, {r6("interest_rate")} AS interest_rate FROM l, (SELECT quantile_cont(interest_rate, 0.01) lo,
      quantile_cont(interest_rate, 0.99) hi FROM l) q WHERE interest_rate >= lo AND interest_rate < hi""",
    f"l AS (SELECT src_pos, interest_rate FROM {LOANS} x WHERE interest_rate > 0)",
)
AVERAGES = (
    "averages AS ("
    + union(
        [
            f"""SELECT activity_year, lei, '{c}' AS measure, AVG(NULLIF({c}, -99999)) AS average_value,
            COUNT(NULLIF({c}, -99999)) AS count_observations FROM {LOANS} x WHERE action_taken = 1 GROUP BY 1, 2
            HAVING COUNT(NULLIF({c}, -99999)) > 0"""
            for c in ("income", "loan_amount", "interest_rate")
        ]
    )
    + ")"
)
put("lender_averages", "lar_raw", f"SELECT * REPLACE ({r6('average_value')} AS average_value) FROM averages", AVERAGES)
put(
    "density_histogram",
    "lar_raw",
    f"""SELECT g.activity_year, CAST(g.b AS INTEGER) AS bin, {r6("lo + (hi - lo) / 100 * g.b")} AS left_edge,
      COALESCE(c, 0) AS cnt, {r6("COALESCE(c, 0) / (n * (hi - lo) / 100)")} AS density
    FROM (SELECT * FROM spans, range(0, 100) t(b)) g
    LEFT JOIN (SELECT activity_year, LEAST(CAST(FLOOR((v - lo) * 100 / (hi - lo)) AS BIGINT), 99) AS b, COUNT(*) AS c
      FROM t JOIN spans USING (activity_year) GROUP BY 1, 2) k ON k.activity_year = g.activity_year AND k.b = g.b""",
    AVERAGES
    + """, a AS (SELECT activity_year, average_value AS v FROM averages WHERE measure = 'loan_amount'),
    t AS (SELECT a.* FROM a, (SELECT quantile_cont(v, 0.01) p, quantile_cont(v, 0.99) q FROM a) x WHERE v >= p AND v < q),
    spans AS (SELECT activity_year, MIN(v) - CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS lo,
      MAX(v) + CASE WHEN MIN(v) = MAX(v) THEN 0.5 ELSE 0 END AS hi, COUNT(*) AS n FROM t GROUP BY 1)""",
)
EXEMPT_RENAMED = (
    "reverse_mortgage", "debt_to_income_ratio", "combined_loan_to_value_ratio", "interest_rate", "property_value",
    "rate_spread", "loan_term", "discount_points", "lender_credits", "aus_1",
)
put(
    "exempt_reporters",
    "lar_wide",
    f"""SELECT src_pos, lei, activity_year, {", ".join(EXEMPT_RENAMED)}, "CountExemptions", {r6('"AverageExemptions"')} AS "AverageExemptions"
    FROM (SELECT *, AVG("CountExemptions") OVER (PARTITION BY lei, activity_year) AS "AverageExemptions"
      FROM (SELECT *, CAST({exempt_total(EXEMPT_RENAMED)} AS BIGINT) AS "CountExemptions"
        FROM (SELECT * RENAME (loan_to_value_ratio AS combined_loan_to_value_ratio) FROM lar_wide) r WHERE action_taken = '1') x) y
    WHERE "AverageExemptions" >= 1 AND "AverageExemptions" < 26""",
)

# --- outliers and models ------------------------------------------------------

put(
    "outlier_zscore",
    "lar_raw",
    """SELECT src_pos, ABS(i - mi) > 6 * si AS outlier_interest_rate, ABS(r - mr) > 6 * sr AS outlier_rate_spread
    FROM v, (SELECT AVG(i) mi, STDDEV_SAMP(i) si, AVG(r) mr, STDDEV_SAMP(r) sr FROM v) s""",
    f"v AS (SELECT src_pos, {real('interest_rate')} AS i, {real('rate_spread')} AS r FROM lar_raw)",
)
put(
    "median_impute",
    "lar_raw",
    "SELECT src_pos, "
    + ", ".join(
        f"{r6(f'CAST(COALESCE({c}, m_{c}) AS DOUBLE)')} AS {c}" for c in ("income", "interest_rate", "debt_to_income_ratio")
    )
    + " FROM v, (SELECT median(income) m_income, median(interest_rate) m_interest_rate, median(debt_to_income_ratio) m_debt_to_income_ratio FROM v) m",
    f"""v AS (SELECT src_pos, NULLIF(income, -99999) AS income, NULLIF(interest_rate, -99999) AS interest_rate,
      NULLIF(debt_to_income_ratio, -99999) AS debt_to_income_ratio FROM {LOANS} x)""",
)
put(
    "hash_split",
    "lar_raw",
    """SELECT src_pos, CAST(CASE WHEN CAST('0x' || substr(md5(CAST(src_pos AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10000 < 7000
      THEN 1 ELSE 0 END AS INTEGER) AS i_train FROM lar_raw""",
)
MARGINS = f"""l AS (SELECT src_pos, lei, CAST(income AS DOUBLE) AS v FROM {LOANS} x WHERE income <> -99999),
    scored AS (SELECT src_pos, lei, 0.1 * (0.9 - ABS(v - m) / s) AS anomaly_score
      FROM l, (SELECT AVG(v) m, STDDEV_SAMP(v) s FROM l) q),
    by_lender AS (SELECT lei, AVG(anomaly_score) AS lei_anomaly_score, COUNT(*) FILTER (anomaly_score < 0) AS lei_anomaly_count,
      COUNT(*) AS count_lei FROM scored GROUP BY lei)"""
put(
    "lender_anomaly_summary",
    "lar_raw",
    f"""SELECT lei, {r6("lei_anomaly_score")} AS lei_anomaly_score, lei_anomaly_count, count_lei FROM by_lender
    WHERE lei_anomaly_score <= 0.01 AND count_lei >= 10 ORDER BY by_lender.lei_anomaly_score, lei LIMIT 10""",
    MARGINS,
)
put(
    "anomalous_loans",
    "lar_raw",
    f"""SELECT src_pos, lei, {r6("anomaly_score")} AS anomaly_score, CAST(-1 AS INTEGER) AS anomaly,
      {r6("lei_anomaly_score")} AS lei_anomaly_score, lei_anomaly_count, count_lei
    FROM scored JOIN by_lender USING (lei) WHERE anomaly_score < 0""",
    MARGINS,
)
# The isolation forest: 100 trees on up to 256 rows, grown level by level. Node n has the children
# 2n and 2n + 1; feature and threshold of a node come from md5 of seed, tree and node.
FOREST = (
    "interest_rate", "loan_amount", "income", "combined_loan_to_value_ratio", "debt_to_income_ratio", "activity_year",
    "discount_points", "lender_credits", "property_value", "loan_type", "loan_purpose", "purchaser_type", "loan_term",
)
FOREST_LEVELS = 8


def digest(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE"


def forest_tables() -> str:
    many = range(len(FOREST))
    depth_left = "CASE WHEN n <= 1 THEN 0.0::DOUBLE WHEN n = 2 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * (ln(n - 1) + 0.5772156649::DOUBLE) - 2.0::DOUBLE * (n - 1) / n END"
    parts = [
        f"""fl AS MATERIALIZED (SELECT src_pos, lei, CAST(CASE WHEN CAST('0x' || substr(md5(CAST(src_pos AS VARCHAR) || '|42'), 1, 8) AS BIGINT) % 10000 < 7000
      THEN 1 ELSE 0 END AS INTEGER) AS i_train, {", ".join(f"NULLIF(CAST({c} AS DOUBLE), -99999) AS m{i}" for i, c in enumerate(FOREST))}
      FROM {WIDE} x WHERE action_taken = 1)""",
        f"fm AS (SELECT {', '.join(f'median(m{i}) AS c{i}' for i in many)} FROM fl)",
        f"ff AS MATERIALIZED (SELECT src_pos, lei, i_train, {', '.join(f'COALESCE(m{i}, c{i}) AS x{i}' for i in many)} FROM fl, fm)",
        "fg AS (SELECT COUNT(*) AS total, LEAST(256, COUNT(*)) AS size, GREATEST(1, CEIL(LOG2(LEAST(256, COUNT(*))))) AS height FROM ff WHERE i_train = 1)",
        f"""f1 AS MATERIALIZED (SELECT tree, 1 AS node, {", ".join(f"x{i}" for i in many)} FROM (SELECT *,
      ROW_NUMBER() OVER (PARTITION BY tree ORDER BY {digest("src_pos", "'42'", "tree", "'draw'")}, src_pos) AS rn
      FROM ff, fg, (SELECT CAST(range AS INTEGER) AS tree FROM range(100)) t
      WHERE i_train = 1 AND {digest("src_pos", "'42'", "'pool'")} < 2 * 100 * size / total::DOUBLE) y WHERE rn <= size)""",
    ]
    for level in range(1, FOREST_LEVELS + 2):
        spans = ", ".join(f"{{'f': {i}, 'lo': MIN(x{i}), 'hi': MAX(x{i})}}" for i in many)
        parts.append(f"""s{level} AS MATERIALIZED (SELECT tree, node, n, CASE WHEN {level - 1} < height AND len(can) > 0
      THEN can[1 + CAST(FLOOR({digest("'42'", "tree", "node", "'feature'")} * len(can)) AS BIGINT)] END AS pick
      FROM (SELECT tree, node, COUNT(*) AS n, list_filter([{spans}], lambda s: s.hi > s.lo) AS can FROM f{level} GROUP BY tree, node) y, fg)""")
        parts.append(f"""n{level} AS MATERIALIZED (SELECT tree, node, pick.f AS f, pick.lo + {digest("'42'", "tree", "node", "'threshold'")} * (pick.hi - pick.lo) AS threshold,
      CASE WHEN pick IS NULL THEN {level - 1} + {depth_left} END AS path FROM s{level})""")
        value = f"[{', '.join(f'x{i}' for i in many)}][f + 1]"
        if level <= FOREST_LEVELS:
            parts.append(f"""f{level + 1} AS MATERIALIZED (SELECT tree, 2 * node + CASE WHEN {value} > threshold THEN 1 ELSE 0 END AS node, {", ".join(f"x{i}" for i in many)}
      FROM f{level} JOIN n{level} USING (tree, node) WHERE f IS NOT NULL)""")
    parts.append(f"w1 AS (SELECT src_pos, tree, 1 AS node, {', '.join(f'x{i}' for i in many)} FROM ff, (SELECT CAST(range AS INTEGER) AS tree FROM range(100)) t)")
    for level in range(1, FOREST_LEVELS + 2):
        parts.append(f"e{level} AS MATERIALIZED (SELECT src_pos, tree, f, threshold, path, node, {', '.join(f'x{i}' for i in many)} FROM w{level} JOIN n{level} USING (tree, node))")
        if level <= FOREST_LEVELS:
            parts.append(f"w{level + 1} AS (SELECT src_pos, tree, 2 * node + CASE WHEN {value} > threshold THEN 1 ELSE 0 END AS node, {', '.join(f'x{i}' for i in many)} FROM e{level} WHERE f IS NOT NULL)")
    ends = " UNION ALL ".join(f"SELECT src_pos, path FROM e{level} WHERE path IS NOT NULL" for level in range(1, FOREST_LEVELS + 2))
    parts.append(f"fd AS (SELECT src_pos, ROUND(-POW(2.0::DOUBLE, -AVG(path) / (SELECT {depth_left} FROM (SELECT size AS n FROM fg) z)), 9) AS raw FROM ({ends}) y GROUP BY src_pos)")
    parts.append("fr AS MATERIALIZED (SELECT src_pos, lei, i_train, raw FROM ff JOIN fd USING (src_pos))")
    parts.append("scored AS MATERIALIZED (SELECT src_pos, lei, i_train, raw - o AS anomaly_score FROM fr, (SELECT quantile_cont(raw, 0.0025) AS o FROM fr WHERE i_train = 1) z)")
    parts.append("""by_lender AS (SELECT lei, AVG(anomaly_score) AS lei_anomaly_score, COUNT(*) FILTER (anomaly_score < 0) AS lei_anomaly_count,
      COUNT(*) AS count_lei FROM scored GROUP BY lei)""")
    return ", ".join(parts)


put(
    "isolation_forest",
    "lar_wide",
    f"""SELECT src_pos, lei, i_train, {r6("anomaly_score")} AS anomaly_score,
      CAST(CASE WHEN anomaly_score < 0 THEN -1 ELSE 1 END AS INTEGER) AS anomaly FROM scored""",
    forest_tables(),
)
put(
    "forest_lender_summary",
    "lar_wide",
    f"""SELECT lei, {r6("lei_anomaly_score")} AS lei_anomaly_score, lei_anomaly_count, count_lei FROM by_lender
    WHERE lei_anomaly_score <= 0.01 AND count_lei >= 10 ORDER BY by_lender.lei_anomaly_score, lei LIMIT 10""",
    forest_tables(),
)
put(
    "forest_anomalous_loans",
    "lar_wide",
    f"""SELECT src_pos, lei, i_train, {r6("anomaly_score")} AS anomaly_score, CAST(-1 AS INTEGER) AS anomaly,
      {r6("lei_anomaly_score")} AS lei_anomaly_score, lei_anomaly_count, count_lei
    FROM scored JOIN by_lender USING (lei) WHERE anomaly_score < 0""",
    forest_tables(),
)

KNN = ("loan_amount", "property_value", "combined_loan_to_value_ratio", "loan_purpose", "activity_year")
SQUARES = " + ".join(f"CAST(a.{c} - b.{c} AS DOUBLE) ** 2" for c in KNN)


def knn(name: str, only: str, k: int, itself: bool) -> None:
    """Distance to the k-th nearest row; each row is compared with all."""
    put(
        name,
        "lar_wide",
        f"""SELECT src_pos, {r6("d")} AS knn_distance, COALESCE(d > (SELECT quantile_cont(d, 0.995) FROM scores), FALSE) AS outlier FROM scores""",
        f"""s AS MATERIALIZED (SELECT src_pos, {", ".join(KNN)} FROM {WIDE} x WHERE {only} AND {" AND ".join(f"{c} IS NOT NULL" for c in KNN)}),
    scores AS (SELECT a.src_pos, sqrt(min({SQUARES}, {k})[{k}]) AS d FROM s a LEFT JOIN s b ON {"TRUE" if itself else "a.src_pos <> b.src_pos"}
      GROUP BY a.src_pos)""",
    )


knn("knn_outlier", "action_taken = 1 AND loan_term = 360 AND loan_type = 1", 15, False)
knn("knn_outlier_all_loans", "TRUE", 15, False)
knn("knn_include_self", "TRUE", 15, True)
ORACLES["knn_outlier_pruned"] = f"SELECT src_pos, outlier FROM ({ORACLES['knn_outlier_all_loans']}) x"

# --- file listings ------------------------------------------------------------

put(
    "sniff_delimiter",
    "text_heads",
    """SELECT file_id, mark AS delimiter FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY file_id
      ORDER BY share DESC, header DESC, pref) AS rn FROM (
        SELECT file_id, mark, pref, length(lines[1]) - length(replace(lines[1], mark, '')) AS header,
          len(list_filter(lines, lambda x: length(x) - length(replace(x, mark, '')) = length(lines[1]) - length(replace(lines[1], mark, '')))) / len(lines) AS share
        FROM (SELECT file_id, list_filter(string_split(regexp_replace(regexp_replace(head, '"[^"]*"', '', 'g'), '\\n[^\\n]*$', ''), chr(10)),
            lambda x: x <> '') AS lines FROM text_heads) t, (VALUES (',', 0), ('|', 1), (chr(9), 2), (';', 3)) d(mark, pref)
      ) s WHERE header > 0) r WHERE rn = 1""",
)
put(
    "route_files",
    "source_files",
    "SELECT file_id, file_name, "
    + first_of(
        [
            ("msamd", "msamd"),
            ("public_ts|transmiss|(^|[_-])ts([_-]|$)", "transmissal_series"),
            ("public_panel|(^|[_-])panel([_-]|$)", "panel"),
            ("mlar|public_lar|(^|[_-])lar([_-]|$)|nationwide", "loans"),
        ],
        "'misc'",
    )
    + " AS dataset FROM source_files",
)
put(
    "transfer_plan",
    "source_files",
    "SELECT file_name, local_size IS NULL OR remote_size <> local_size AS need_transfer FROM source_files",
)
put(
    "transfer_plan_newer",
    "source_files",
    "SELECT file_name, local_size IS NULL OR remote_modified > local_modified AS need_transfer FROM source_files",
)
put(
    "pending_sources",
    "source_files",
    """SELECT file_id, regexp_replace(regexp_replace(regexp_replace(file_name, '\\.[^.]*$', ''), '_csv$', ''), '_pipe$', '') AS source
    FROM source_files WHERE local_size IS NULL""",
)
put(
    "year_series_coverage",
    "source_files",
    """SELECT y AS year, MIN(file_name) AS path, COUNT(file_name) AS files FROM range(2010, 2025) t(y)
    LEFT JOIN (SELECT file_name FROM source_files WHERE regexp_matches(file_name, 'public|nationwide')) f
      ON contains(file_name, CAST(y AS VARCHAR)) GROUP BY y""",
)

# --- planned corrections ------------------------------------------------------

UNIT_COLUMNS = {
    "src_pos": "src_pos",
    "lei": "lei",
    "activity_year": whole("activity_year"),
    "file_type": "file_type",
    "income": INCOME,
    "interest_rate": real(f"({exempt('interest_rate')})"),
    "combined_loan_to_value_ratio": real(f"({exempt('loan_to_value_ratio')})"),
    "loan_amount": whole("loan_amount"),
    "loan_term": whole(f"({exempt('loan_term')})"),
    "discount_points": real(f"({exempt('discount_points')})"),
}
FIXED = f"""u AS (SELECT {", ".join(f"{e} AS {n}" for n, e in UNIT_COLUMNS.items())} FROM lar_units),
  c AS (SELECT *,
    CASE WHEN lei = 'LEI00000000000000001' AND activity_year IN (2018, 2019) AND file_type = 'a' THEN 0.001 END AS f_income,
    CASE WHEN lei = 'LEI00000000000000001' AND activity_year = 2018 AND file_type = 'b' THEN 100.0 END AS f_rate,
    lei = 'LEI00000000000000002' AND activity_year = 2021 AND file_type = 'c' AS no_term,
    lei = 'LEI00000000000000002' AND activity_year = 2022 AND file_type = 'b' AS no_points,
    CASE WHEN lei = 'LEI00000000000000003' AND activity_year = 2023 AND file_type = 'c' THEN 0.01 END AS f_amount FROM u)"""
FIXED_COLUMNS = (
    "income", "interest_rate", "combined_loan_to_value_ratio", "loan_amount", "loan_term", "discount_points",
)
WHOLE_COLUMNS = ("income", "loan_amount", "loan_term")


def fixed(known: bool, rules: bool) -> dict[str, str]:
    out = {}
    rule = {
        "income": ("income > 900000 AND income < 10000000000", "0.001"),
        "interest_rate": ("interest_rate > 0 AND interest_rate < 1", "100.0"),
        "combined_loan_to_value_ratio": ("combined_loan_to_value_ratio > 0 AND combined_loan_to_value_ratio < 2", "100.0"),
    }
    factor = {"income": "f_income", "interest_rate": "f_rate", "loan_amount": "f_amount"}
    gone = {"loan_term": "no_term", "discount_points": "no_points"}
    for c in FIXED_COLUMNS:
        parts = []
        if known and c in factor:
            parts.append(f"WHEN {c} <> -99999 AND {factor[c]} IS NOT NULL THEN CAST({c} AS DOUBLE) * {factor[c]}")
        if known and c in gone:
            parts.append(f"WHEN {gone[c]} THEN NULL")
        if rules and c in rule:
            parts.append(f"WHEN {rule[c][0]} THEN CAST({c} AS DOUBLE) * {rule[c][1]}")
        expr = f"CASE {' '.join(parts)} ELSE CAST({c} AS DOUBLE) END" if parts else f"CAST({c} AS DOUBLE)"
        out[c] = f"CAST(ROUND({expr}) AS BIGINT)" if c in WHOLE_COLUMNS else expr
    return out


def correction_body(known: bool, rules: bool) -> str:
    exprs = fixed(known, rules)
    cols = ", ".join(
        f"{e if c in WHOLE_COLUMNS else r6(e)} AS {c}" for c, e in exprs.items()
    )
    flag = " OR ".join(f"({c} IS DISTINCT FROM ({e}))" for c, e in exprs.items())
    return f"SELECT src_pos, {cols}, ({flag}) AS dq_flag FROM c"


SHIPPED = f"""u AS (SELECT {", ".join(f"{e} AS {n}" for n, e in UNIT_COLUMNS.items())} FROM lar_known),
  k(k_lei, k_year, k_type, field, factor, above, note) AS (VALUES {rows_of(KNOWN_CORRECTIONS)}),
  c AS (SELECT u.*, {", ".join(f"MAX(factor) FILTER (field = '{c}' AND (above IS NULL OR {c} > above)) AS f_{c}, COALESCE(BOOL_OR(field = '{c}' AND factor IS NULL), FALSE) AS no_{c}" for c in FIXED_COLUMNS)}
    FROM u LEFT JOIN k ON lei = k_lei AND activity_year = k_year AND file_type = k_type GROUP BY ALL)"""
SHIPPED_VALUES = {
    c: f"CASE WHEN no_{c} THEN NULL WHEN {c} <> -99999 AND f_{c} IS NOT NULL THEN CAST({c} AS DOUBLE) * CAST(f_{c} AS DOUBLE) ELSE CAST({c} AS DOUBLE) END"
    for c in FIXED_COLUMNS
}
SHIPPED_VALUES |= {c: f"CAST(ROUND({SHIPPED_VALUES[c]}) AS BIGINT)" for c in WHOLE_COLUMNS}
put(
    "known_corrections",
    "lar_known",
    "SELECT src_pos, "
    + ", ".join(f"{e if c in WHOLE_COLUMNS else r6(e)} AS {c}" for c, e in SHIPPED_VALUES.items())
    + f", ({' OR '.join(f'({c} IS DISTINCT FROM ({e}))' for c, e in SHIPPED_VALUES.items())}) AS dq_flag FROM c",
    SHIPPED,
)
put(
    "review_flags",
    "lar_known",
    """SELECT u.src_pos, u.lei, u.activity_year, u.file_type, u.loan_amount, u.loan_term,
      reason IS NOT NULL AS review_flag, reason AS review_reasons
    FROM u LEFT JOIN r ON u.lei = k_lei AND u.activity_year = k_year AND u.file_type = k_type AND (
      field = 'loan_amount' AND loan_amount IS NOT NULL AND loan_amount <> -99999 AND loan_amount >= COALESCE(least, loan_amount)
      OR field = 'loan_term' AND loan_term IS NOT NULL AND loan_term <> -99999 AND loan_term >= COALESCE(least, loan_term))""",
    f"""u AS (SELECT {", ".join(f"{e} AS {n}" for n, e in UNIT_COLUMNS.items())} FROM lar_known),
    r(k_lei, k_year, k_type, field, least, reason) AS (VALUES {rows_of(REVIEWS)})""",
)
put("lender_corrections", "lar_units", correction_body(True, False), FIXED)
put("rule_corrections", "lar_units", correction_body(False, True), FIXED)
KNOWN_HIT = {
    "income": "f_income IS NOT NULL",
    "interest_rate": "f_rate IS NOT NULL",
    "loan_amount": "f_amount IS NOT NULL",
    "loan_term": "no_term",
    "discount_points": "no_points",
}
AUDIT = (
    "audit AS ("
    + union(
        [
            f"""SELECT src_pos, lei, activity_year, '{c}' AS field_name, CAST({c} AS DOUBLE) AS original_value,
            CAST({e} AS DOUBLE) AS corrected_value, CASE WHEN {KNOWN_HIT.get(c, "FALSE")} THEN 'lender' ELSE 'rule' END AS correction_type
            FROM c WHERE {c} IS DISTINCT FROM ({e})"""
            for c, e in fixed(True, True).items()
        ]
    )
    + ")"
)
put(
    "correction_audit",
    "lar_units",
    f"SELECT * REPLACE ({r6('original_value')} AS original_value, {r6('corrected_value')} AS corrected_value) FROM audit",
    f"{FIXED}, {AUDIT}",
)
put(
    "repeat_lenders",
    "lar_units",
    "SELECT lei, COUNT(DISTINCT activity_year) AS years, COUNT(*) AS corrections FROM audit GROUP BY lei HAVING COUNT(DISTINCT activity_year) >= 2",
    f"{FIXED}, {AUDIT}",
)
PROBS = (0.01, 0.25, 0.5, 0.75, 0.99)
put(
    "correction_profile",
    "lar_units",
    union(
        [
            f"""SELECT '{c}' AS field_name, '{stage}' AS stage, CAST({p} AS DOUBLE) AS prob,
            {r6(f"quantile_cont(NULLIF(CAST({e} AS DOUBLE), -99999), {p})")} AS value FROM c"""
            for c in ("interest_rate", "loan_amount")
            for stage, e in (("before", c), ("after", fixed(True, True)[c]))
            for p in PROBS
        ]
    ),
    FIXED,
)

# --- planned market analyses --------------------------------------------------

VOLUMES = f"""v AS (SELECT county_code, activity_year, lei, CAST(SUM(loan_amount) AS BIGINT) AS volume, COUNT(*) AS loans
    FROM {LOANS} x GROUP BY 1, 2, 3)"""
put(
    "hhi",
    "lar_raw",
    f"""SELECT county_code, activity_year, COUNT(volume) AS lenders,
      {r6("10000.0 * SUM(CAST(volume AS DOUBLE) ** 2) / SUM(CAST(volume AS DOUBLE)) ** 2")} AS hhi FROM v GROUP BY 1, 2""",
    VOLUMES,
)
put(
    "concentration_ratio",
    "lar_raw",
    f"""SELECT county_code, activity_year, {r6("SUM(volume) FILTER (rn <= 4) / CAST(SUM(volume) AS DOUBLE)")} AS cr4,
      {r6("SUM(volume) FILTER (rn <= 8) / CAST(SUM(volume) AS DOUBLE)")} AS cr8
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY county_code, activity_year ORDER BY volume DESC NULLS LAST, lei) AS rn FROM v) x GROUP BY 1, 2""",
    VOLUMES,
)
put(
    "share_change",
    "lar_raw",
    f"""SELECT county_code, activity_year, lei, {r6("share")} AS share,
      {r6("share - LAG(share) OVER (PARTITION BY county_code, lei ORDER BY activity_year)")} AS change
    FROM (SELECT *, volume / CAST(SUM(volume) OVER (PARTITION BY county_code, activity_year) AS DOUBLE) AS share FROM v) x""",
    VOLUMES,
)
put(
    "origination_ratio",
    "lar_raw",
    f"""SELECT lei, COUNT(*) FILTER (action_taken BETWEEN 1 AND 5) AS applications, COUNT(*) FILTER (action_taken = 1) AS originations,
      {r6("COUNT(*) FILTER (action_taken = 1) / CAST(NULLIF(COUNT(*) FILTER (action_taken BETWEEN 1 AND 5), 0) AS DOUBLE)")} AS origination_ratio,
      {r6("AVG(loan_amount)")} AS average_loan_amount FROM {LOANS} x GROUP BY lei""",
)
put(
    "entry_exit",
    "lar_raw",
    f"""SELECT county_code, lei, MIN(activity_year) AS entry_year, MAX(activity_year) AS exit_year,
      COUNT(DISTINCT activity_year) AS active_years FROM {LOANS} x GROUP BY 1, 2""",
)
put(
    "volume_rollup",
    "lar_raw",
    union(
        [
            f"SELECT '{c}' AS level, {c} AS code, COUNT(*) AS loans, CAST(SUM(loan_amount) AS BIGINT) AS volume FROM {LOANS} x GROUP BY {c}"
            for c in ("census_tract", "county_code", "state_code")
        ]
    ),
)
put(
    "disparate_impact",
    "lar_raw",
    f"""SELECT r.lei, r.g AS "group", r.decisions, {r6("r.rate")} AS approval_rate, {r6("r.rate / NULLIF(b.rate, 0)")} AS impact_ratio
    FROM r LEFT JOIN r b ON r.lei = b.lei AND b.g = 0""",
    f"""r AS (SELECT lei, applicant_age_above_62 AS g, COUNT(*) AS decisions, AVG(CASE WHEN action_taken IN (1, 2) THEN 1.0 ELSE 0.0 END) AS rate
      FROM {LOANS} x WHERE action_taken IN (1, 2, 3) AND applicant_age_above_62 IS NOT NULL GROUP BY 1, 2)""",
)
put(
    "purchase_edges",
    "lar_wide",
    f"""SELECT lei, purchaser_type, activity_year, COUNT(*) AS loans, CAST(SUM(loan_amount) AS BIGINT) AS volume
    FROM {WIDE} x WHERE purchaser_type <> 0 GROUP BY 1, 2, 3""",
)
TREND = f"""t AS (SELECT state_code, activity_year, COUNT(*) AS loans, CAST(SUM(loan_amount) AS BIGINT) AS volume,
    AVG(NULLIF(interest_rate, -99999)) AS rate FROM {LOANS} x GROUP BY 1, 2)"""
put(
    "volume_trend",
    "lar_raw",
    f"""SELECT state_code, activity_year, loans, volume, {r6("rate")} AS average_rate,
      loans - LAG(loans) OVER w AS loans_change, {r6("rate - LAG(rate) OVER w")} AS rate_change
    FROM t WINDOW w AS (PARTITION BY state_code ORDER BY activity_year)""",
    TREND,
)
put(
    "volume_slope",
    "lar_raw",
    f"""SELECT state_code, COUNT(*) AS years, {r6("regr_slope(loans, activity_year)")} AS loans_slope,
      {r6("regr_slope(rate, activity_year)")} AS rate_slope FROM t GROUP BY 1""",
    TREND,
)
put(
    "assessment_ratio",
    "lar_raw",
    f"""SELECT lei, CAST(SUM(n) AS BIGINT) AS originations, CAST(SUM(CASE WHEN county_code IS NOT NULL AND n >= 0.02 * total THEN n ELSE 0 END) AS BIGINT) AS inside,
      {r6("SUM(CASE WHEN county_code IS NOT NULL AND n >= 0.02 * total THEN n ELSE 0 END) / CAST(SUM(n) AS DOUBLE)")} AS inside_ratio
    FROM (SELECT *, SUM(n) OVER (PARTITION BY lei) AS total FROM (SELECT lei, county_code, COUNT(*) AS n FROM {LOANS} x
      WHERE action_taken = 1 GROUP BY 1, 2) y) z GROUP BY lei""",
)
put(
    "rate_gap",
    "lar_raw",
    f"""SELECT '1' AS group_a, '0' AS group_b, {r6("y1 - y0")} AS gap, {r6("b0 * (x1 - x0)")} AS explained,
      {r6("(y1 - y0) - b0 * (x1 - x0)")} AS unexplained
    FROM (SELECT AVG(y) FILTER (g = 1) y1, AVG(y) FILTER (g = 0) y0, AVG(x) FILTER (g = 1) x1, AVG(x) FILTER (g = 0) x0,
      regr_slope(y, x) FILTER (g = 0) b0 FROM d) s""",
    f"""d AS (SELECT applicant_age_above_62 AS g, NULLIF(interest_rate, -99999) AS y, NULLIF(combined_loan_to_value_ratio, -99999) AS x
      FROM {LOANS} z WHERE NULLIF(interest_rate, -99999) IS NOT NULL AND NULLIF(combined_loan_to_value_ratio, -99999) IS NOT NULL)""",
)

put(
    "structure_report",
    "lar_raw",
    f"""SELECT county_code, activity_year, COUNT(*) AS lenders, SUM(loans)::BIGINT AS loans, {r6("SUM(v)")} AS volume, {r6("10000 * SUM(v * v) / NULLIF(SUM(v), 0) ** 2")} AS hhi,
      {", ".join(f"{r6(f'SUM(CASE WHEN k <= {n} THEN v ELSE 0 END) / NULLIF(SUM(v), 0)')} AS cr{n}" for n in (1, 4, 8))},
      MIN(lei) FILTER (k = 1) AS largest_lender, COUNT(*) FILTER (comes) AS entries, COUNT(*) FILTER (goes) AS exits,
      CASE WHEN 10000 * SUM(v * v) / NULLIF(SUM(v), 0) ** 2 > 1800 THEN 'high' WHEN 10000 * SUM(v * v) / NULLIF(SUM(v), 0) ** 2 >= 1000 THEN 'moderate'
        WHEN SUM(v) <> 0 THEN 'low' END AS concentration
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY county_code, activity_year ORDER BY v DESC, lei) AS k,
        MIN(activity_year) OVER (PARTITION BY county_code, lei) = activity_year AS comes, MAX(activity_year) OVER (PARTITION BY county_code, lei) = activity_year AS goes
      FROM (SELECT county_code, activity_year, lei, COALESCE(SUM(loan_amount), 0)::DOUBLE AS v, COUNT(*) AS loans FROM {LOANS} x GROUP BY 1, 2, 3) y) z
    GROUP BY county_code, activity_year""",
)
put(
    "lender_scorecard",
    "lar_raw",
    f"""SELECT lei, activity_year, applications, originations, {r6("origination_ratio")} AS origination_ratio, {r6("approval_rate")} AS approval_rate, markets, volume,
      {r6("average_loan_amount")} AS average_loan_amount, {r6("average_interest_rate")} AS average_interest_rate, {r6("share")} AS share, rank::INTEGER AS rank, {r6("percentile")} AS percentile,
      {r6("share - LAG(share) OVER h")} AS share_change, (rank - LAG(rank) OVER h)::INTEGER AS rank_change
    FROM (SELECT *, volume / NULLIF(SUM(volume) OVER (PARTITION BY activity_year), 0) AS share, RANK() OVER (PARTITION BY activity_year ORDER BY volume DESC) AS rank,
        PERCENT_RANK() OVER (PARTITION BY activity_year ORDER BY volume) AS percentile
      FROM (SELECT lei, activity_year, COUNT(*) FILTER (action_taken IN (1, 2, 3, 4, 5)) AS applications, COUNT(*) FILTER (action_taken = 1) AS originations,
          COUNT(*) FILTER (action_taken = 1) / NULLIF(COUNT(*) FILTER (action_taken IN (1, 2, 3, 4, 5)), 0) AS origination_ratio,
          COUNT(*) FILTER (action_taken IN (1, 2)) / NULLIF(COUNT(*) FILTER (action_taken IN (1, 2, 3)), 0) AS approval_rate,
          COUNT(DISTINCT county_code) FILTER (action_taken = 1) AS markets, COALESCE(SUM(loan_amount) FILTER (action_taken = 1), 0)::BIGINT AS volume,
          AVG(loan_amount) FILTER (action_taken = 1) AS average_loan_amount, AVG(NULLIF(interest_rate, -99999)) FILTER (action_taken = 1) AS average_interest_rate
        FROM {LOANS} x GROUP BY lei, activity_year) y) z
    WINDOW h AS (PARTITION BY lei ORDER BY activity_year)""",
)


def full_code(c: str, width: int) -> str:
    """``code`` for numbers of more digits than the width, and signed ones."""
    n = f"CAST(CAST(TRUNC({real(c)}) AS BIGINT) AS VARCHAR)"
    return f"CASE WHEN LENGTH({n}) >= {width} THEN {n} WHEN {n} LIKE '-%' THEN '-' || LPAD({n}[2:], {width - 1}, '0') ELSE LPAD({n}, {width}, '0') END"


TRAPS = post2018("lar_traps").replace(code("county_code", 5), full_code("county_code", 5)).replace(code("census_tract", 11), full_code("census_tract", 11))
TRAP_DOUBLES = [f"CASE WHEN isfinite({d}) THEN {r6(d)} END AS {d}" for d in DOUBLES[:3]]
put("harmonize_traps", "lar_traps", f"SELECT * REPLACE ({', '.join(TRAP_DOUBLES)}) FROM {TRAPS} x")


def residuals(names: list[str]) -> str:
    """Covariates and outcome of the base group, each less what those before it predict."""
    steps = [f"r0 AS (SELECT *, y AS y_0, {', '.join(f'{n} AS {n}_0' for n in names)} FROM d WHERE g = 0)"]
    for k, name in enumerate(names):
        later = [*names[k + 1 :], "y"]
        own = f"({name}_{k} - AVG({name}_{k}) OVER ())"
        left = ", ".join(f"{c}_{k} - AVG({c}_{k}) OVER () - (regr_slope({c}_{k}, {name}_{k}) OVER ()) * {own} AS {c}_{k + 1}" for c in later)
        steps.append(f"r{k + 1} AS (SELECT *, {left} FROM r{k})")
    return ", ".join(steps)


COVARIATES = ["x1", "x2", "db", "dc"]
# slope of the outcome on what is left of each covariate, and of later covariates on it; then back
BACK = ", ".join(f"regr_slope(y_{k}, {n}_{k}) AS g{k}" for k, n in enumerate(COVARIATES)) + "".join(
    f", regr_slope({m}_{k}, {n}_{k}) AS h{k}{j}" for k, n in enumerate(COVARIATES) for j, m in enumerate(COVARIATES) if j > k
)
put(
    "rate_decomposition",
    "lar_raw",
    """SELECT covariate, (ROUND(value, 6) + 0.0) AS contribution, (ROUND(value / gap, 6) + 0.0) AS share FROM p, (
      SELECT UNNEST([{'c': 'combined_loan_to_value_ratio', 'v': b0 * m0}, {'c': 'loan_amount', 'v': b1 * m1}, {'c': 'file_type', 'v': b2 * m2 + b3 * m3},
        {'c': '(gap)', 'v': gap}, {'c': '(unexplained)', 'v': gap - b0 * m0 - b1 * m1 - b2 * m2 - b3 * m3}]) AS u FROM p) q, LATERAL (SELECT u.c AS covariate, u.v AS value) z""",
    f"""d AS (SELECT applicant_age_above_62 AS g, NULLIF(interest_rate, -99999) AS y, NULLIF(combined_loan_to_value_ratio, -99999) AS x1,
        NULLIF(loan_amount, -99999)::DOUBLE AS x2, (file_type = 'b')::INT::DOUBLE AS db, (file_type = 'c')::INT::DOUBLE AS dc
      FROM {LOANS} z WHERE NULLIF(interest_rate, -99999) IS NOT NULL AND NULLIF(combined_loan_to_value_ratio, -99999) IS NOT NULL AND NULLIF(loan_amount, -99999) IS NOT NULL),
    {residuals(COVARIATES)},
    s AS (SELECT {BACK} FROM r4),
    b3 AS (SELECT *, g3 AS b3 FROM s), b2 AS (SELECT *, g2 - h23 * b3 AS b2 FROM b3), b1 AS (SELECT *, g1 - h12 * b2 - h13 * b3 AS b1 FROM b2),
    b0 AS (SELECT *, g0 - h01 * b1 - h02 * b2 - h03 * b3 AS b0 FROM b1),
    p AS (SELECT b0, b1, b2, b3, m.* FROM b0, (SELECT AVG(y) FILTER (g = 1) - AVG(y) FILTER (g = 0) AS gap,
      {', '.join(f'AVG({n}) FILTER (g = 1) - AVG({n}) FILTER (g = 0) AS m{k}' for k, n in enumerate(COVARIATES))} FROM d) m)""",
)
put(
    "network_rank",
    "lar_raw",
    f"""SELECT n.side, n.node, n.degree, {r6("n.strength")} AS strength, {r6("w.score")} AS score
    FROM n JOIN w ON w.side = n.side AND w.node = n.node AND w.k = (SELECT MAX(k) FROM w)""",
    f"""e AS (SELECT lei AS l, county_code AS r, COUNT(*)::DOUBLE AS weight FROM {LOANS} x WHERE lei IS NOT NULL AND county_code IS NOT NULL GROUP BY 1, 2),
    ways AS (SELECT 'left' AS side, l AS node, r AS other, weight FROM e UNION ALL SELECT 'right', r, l, weight FROM e),
    n AS (SELECT side, node, COUNT(*) AS degree, SUM(weight) AS strength FROM ways GROUP BY 1, 2),
    z AS (SELECT COUNT(*) AS size FROM n),
    steps AS (SELECT a.side, a.node, a.other, a.weight / b.strength AS share FROM ways a JOIN n b ON a.side <> b.side AND a.other = b.node),
    w AS (WITH RECURSIVE w AS (
      SELECT 0 AS k, side, node, 1.0::DOUBLE / size AS score, 1.0::DOUBLE AS change FROM n, z
      UNION ALL
      SELECT k, side, node, score, SUM(ABS(score - before)) OVER () AS change FROM (
        SELECT MAX(w.k) + 1 AS k, s.side, s.node, 0.4::DOUBLE / MAX(size) + 0.6::DOUBLE * SUM(w.score * s.share) AS score, MAX(o.score) AS before
        FROM steps s JOIN w ON w.side <> s.side AND w.node = s.other JOIN w o ON o.side = s.side AND o.node = s.node, z
        WHERE w.change >= 0.0001 AND w.k < 100 GROUP BY s.side, s.node) x
    ) SELECT * FROM w)""",
)

# --- over files: registered by their own module ------------------------------

from . import layer_oracles  # noqa: E402, F401
