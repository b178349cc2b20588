"""DuckDB counterparts of the queries over files."""

from __future__ import annotations

from .oracles import BOTH, COMBINED, INCOME, ORACLES, exempt, put, r6, real, whole

EXTRA = ",one,\"two, more\""
BRONZE = "src_pos, activity_year, lei, state_code, county_code, loan_amount, income, loan_to_value_ratio"

put(
    "archive_members",
    "archive_rows",
    """SELECT archive_name, archive_year AS year, member, (LENGTH(MIN(header)) + 1 + SUM(LENGTH(line) + 1))::BIGINT AS size,
      (COUNT(*) OVER (PARTITION BY archive_name))::INTEGER AS tables, source
    FROM archive_rows GROUP BY archive_name, archive_year, member, source""",
)
put(
    "bronze_rows",
    "archive_rows",
    """SELECT CAST(src_pos AS VARCHAR) AS src_pos, activity_year, lei, state_code, county_code, loan_amount, income,
      CASE WHEN src_pos % 43 <> 0 THEN loan_to_value_ratio END AS loan_to_value_ratio, file_type,
      archive_year || file_type || '_' || LPAD(CAST(ROW_NUMBER() OVER (PARTITION BY source ORDER BY src_pos) - 1 AS VARCHAR), 9, '0') AS "HMDAIndex",
      source FROM archive_rows""",
)
put(
    "bronze_rows_2007_2017",
    "lar_2007_2017",
    """SELECT CAST(COLUMNS(* EXCLUDE (derived_race, state_code, rate_spread)) AS VARCHAR), NULLIF(state_code, '') AS state_code, NULLIF(rate_spread, '') AS rate_spread,
      'hmda_' || as_of_year || '_nationwide_codes' AS source FROM lar_2007_2017""",
)
put("bronze_rows_pre2007", "lar_pre2007", "SELECT CAST(COLUMNS(*) AS VARCHAR), 'loans_' || activity_year AS source FROM lar_pre2007")
put(
    "malformed_lines",
    "archive_rows",
    f"""SELECT source, 'long' AS kind, CASE WHEN src_pos % 43 = 0 THEN 10 ELSE 11 END AS fields, 9 AS expected, line || '{EXTRA}' AS line
    FROM archive_rows WHERE src_pos % 41 = 0""",
)
TYPED = f"""src_pos, CAST(activity_year AS BIGINT) AS activity_year, file_type, lei, {whole("loan_amount")} AS loan_amount, {INCOME} AS income,
  {r6(real("(" + exempt("loan_to_value_ratio") + ")"))} AS combined_loan_to_value_ratio"""
LEFT = "NOT (archive_year = 2019 AND (src_pos % 2 = 1 OR activity_year <> '2019')) AND NOT (archive_year = 2021 AND file_type = 'b')"
put("silver_second_import", "archive_rows", f"SELECT {TYPED} FROM archive_rows WHERE {LEFT}")
put("stream_refresh", "archive_rows", f"SELECT {TYPED} FROM archive_rows WHERE {LEFT}")
put(
    "silver_ledger",
    "archive_rows",
    f"""SELECT archive AS source, CAST(activity_year AS BIGINT) AS activity_year, file_type, COUNT(*) AS "rows"
    FROM archive_rows WHERE {LEFT} GROUP BY archive, activity_year, file_type""",
)
put(
    "silver_canonical",
    "archive_rows",
    f"""SELECT CAST(src_pos AS VARCHAR) AS src_pos, lei, {whole("loan_amount")} AS loan_amount,
      CASE WHEN archive_year >= 2021 THEN {INCOME} END AS income,
      CAST(NULL AS BIGINT) AS property_value, CAST(activity_year AS BIGINT) AS activity_year, file_type FROM archive_rows""",
)
put(
    "import_status",
    "archive_rows",
    """SELECT * FROM (SELECT 'loans' AS dataset, TRUE AS done, COUNT(*) AS "rows" FROM archive_rows
    UNION ALL SELECT 'panel', FALSE, NULL UNION ALL SELECT 'transmissal_series', TRUE, NULL) x""",
)
put("lender_files", BOTH, "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM combined", COMBINED)
ORACLES["tract_dimension_rows"] = ORACLES["tract_dimension"]
