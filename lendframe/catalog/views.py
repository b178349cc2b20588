"""Mortgage-shaped views derived from the given tables.

The given tables hold no mortgage data, so each view derives a bronze table, dirt
included, from them. The SQL runs unchanged in Spark and DuckDB; every view grows
with its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {}
TABLES = ("orders", "customer", "supplier", "nation")

VIEWS["lar_raw"] = """
SELECT
 o_orderkey AS src_pos,
 CAST(2018 + o_orderkey % 7 AS STRING) AS activity_year,
 CASE WHEN o_orderkey % 7 >= 5 THEN 'c' WHEN o_orderkey % 7 >= 3 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'b' ELSE 'c' END
      ELSE CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END END AS file_type,
 CASE WHEN o_orderkey % 1200 = 0 THEN 'ODD' ELSE 'LEI' END || LPAD(CAST(CASE WHEN o_orderkey % 1200 = 0 THEN 0 ELSE o_custkey % 50 END AS STRING), 17, '0') AS lei,
 CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE ' U' || CAST(o_orderkey % 9000 AS STRING) || ' ' END AS universal_loan_identifier,
 CASE c_nationkey % 4 WHEN 0 THEN 'DC' WHEN 1 THEN 'MD' WHEN 2 THEN 'VA' ELSE 'CA' END AS state_code,
 CASE WHEN o_orderkey % 19 = 0 THEN 'NA' ELSE CAST(1001 + c_nationkey * 1000 + o_orderkey % 3 AS STRING) || CASE WHEN o_orderkey % 2 = 0 THEN '.0' ELSE '' END END AS county_code,
 CASE WHEN o_orderkey % 23 = 0 THEN 'NA' ELSE CAST(1001950900 + CAST(c_nationkey AS BIGINT) * 1000000000 + o_orderkey % 40 AS STRING) END AS census_tract,
 CAST(1 + o_orderkey % 8 AS STRING) AS action_taken,
 CAST(5000 + 10000 * (CAST(FLOOR(o_totalprice) AS BIGINT) % 60) AS STRING) || CASE WHEN o_orderkey % 29 = 0 THEN '.0' ELSE '' END AS loan_amount,
 CASE WHEN o_orderkey % 17 = 0 THEN 'Exempt' WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE CAST(20 + o_orderkey % 400 AS STRING) END AS income,
 CASE WHEN o_orderkey % 17 = 0 THEN 'Exempt' WHEN o_orderkey % 11 = 0 THEN 'NA' WHEN o_orderkey % 997 = 0 THEN '95.0' ELSE CAST(2 + o_orderkey % 6 AS STRING) || '.' || LPAD(CAST(o_orderkey % 1000 AS STRING), 3, '0') END AS interest_rate,
 CASE WHEN o_orderkey % 17 = 0 THEN 'Exempt' WHEN o_orderkey % 31 = 0 THEN '-25.5' ELSE CAST(o_orderkey % 5 AS STRING) || '.25' END AS rate_spread,
 CASE WHEN o_orderkey % 17 = 0 THEN 'Exempt' ELSE CAST(40 + o_orderkey % 180 AS STRING) || '.5' END AS loan_to_value_ratio,
 CASE o_orderkey % 9 WHEN 0 THEN '<20%' WHEN 1 THEN '20%-<30%' WHEN 2 THEN '30%-<36%' WHEN 3 THEN '50%-60%' WHEN 4 THEN '>60%' WHEN 5 THEN 'Exempt' WHEN 6 THEN 'NA' ELSE CAST(36 + o_orderkey % 14 AS STRING) END AS debt_to_income_ratio,
 CASE o_orderkey % 7 WHEN 0 THEN '5-24' WHEN 1 THEN '25-49' WHEN 2 THEN '50-99' WHEN 3 THEN '100-149' WHEN 4 THEN '>149' ELSE CAST(1 + o_orderkey % 4 AS STRING) END AS total_units,
 CASE o_orderkey % 9 WHEN 0 THEN '<25' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45-54' WHEN 4 THEN '55-64' WHEN 5 THEN '65-74' WHEN 6 THEN '>74' WHEN 7 THEN '8888' ELSE '9999' END AS applicant_age,
 CASE o_orderkey % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'yes' WHEN 3 THEN 'NO' ELSE 'NA' END AS applicant_age_above_62,
 CASE o_orderkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'NC' WHEN 2 THEN 'U' ELSE 'NA' END AS conforming_loan_limit,
 CASE WHEN o_orderkey % 17 = 0 THEN 'Exempt' ELSE CAST(120 * (1 + o_orderkey % 3) AS STRING) END AS loan_term
FROM orders JOIN customer ON o_custkey = c_custkey
"""

VIEWS["lar_2007_2017"] = """
SELECT
 o_orderkey AS src_pos,
 CAST(2007 + o_orderkey % 11 AS STRING) AS as_of_year,
 CAST(10000 + o_custkey % 50 AS STRING) AS respondent_id,
 CAST(1 + o_orderkey % 9 AS STRING) AS agency_code,
 CAST(o_orderkey % 7000 AS STRING) AS sequence_number,
 CASE WHEN o_orderkey % 37 = 0 THEN '' ELSE CAST(1 + c_nationkey AS STRING) END AS state_code,
 CAST(1 + o_orderkey % 200 AS STRING) AS county_code,
 CASE WHEN o_orderkey % 23 = 0 THEN 'NA' ELSE CAST(1 + o_orderkey % 9000 AS STRING) || '.' || LPAD(CAST(o_orderkey % 100 AS STRING), 2, '0') END AS census_tract_number,
 CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(100 + o_orderkey % 49000 AS STRING) END AS msamd,
 CAST(5 + o_orderkey % 900 AS STRING) AS loan_amount_000s,
 CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE CAST(20 + o_orderkey % 400 AS STRING) END AS applicant_income_000s,
 CAST(1 + o_orderkey % 3 AS STRING) AS owner_occupancy,
 CAST(1 + o_orderkey % 8 AS STRING) AS action_taken,
 CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey % 6 AS STRING) || '.75' END AS rate_spread,
 CAST(1000 + o_orderkey % 8000 AS STRING) AS population,
 'x' AS derived_race
FROM orders JOIN customer ON o_custkey = c_custkey
"""

VIEWS["lar_pre2007"] = """
SELECT
 o_orderkey AS src_pos,
 CAST(1990 + o_orderkey % 17 AS STRING) AS activity_year,
 CASE WHEN o_orderkey % 3 = 0 THEN '95-' || CAST(2318940 + o_custkey AS STRING) ELSE CAST(o_custkey AS STRING) END AS respondent_id,
 CASE o_orderkey % 6 WHEN 0 THEN 'B' WHEN 1 THEN 'C' ELSE CAST(o_orderkey % 6 AS STRING) END AS agency_code,
 CAST(o_orderkey % 7000 AS STRING) AS sequence_number,
 CAST(1 + c_nationkey AS STRING) AS state_code,
 CAST(1 + o_orderkey % 200 AS STRING) AS county_code,
 CASE WHEN o_orderkey % 23 = 0 THEN 'NA' ELSE CAST(1 + o_orderkey % 9000 AS STRING) || '.' || LPAD(CAST(o_orderkey % 100 AS STRING), 2, '0') END AS census_tract,
 CAST(100 + o_orderkey % 49000 AS STRING) AS msamd,
 CAST(5 + o_orderkey % 900 AS STRING) AS loan_amount,
 CASE WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE CAST(20 + o_orderkey % 400 AS STRING) END AS income,
 CAST(1 + o_orderkey % 3 AS STRING) AS occupancy,
 CASE WHEN o_orderkey % 10 = 0 THEN '*' ELSE CAST(1 + o_orderkey % 4 AS STRING) END AS applicant_sex,
 CAST(5 + o_orderkey % 3 AS STRING) AS edit_status
FROM orders JOIN customer ON o_custkey = c_custkey
"""

VIEWS["panel_raw"] = """
SELECT
 CAST(2018 + s_suppkey % 7 AS STRING) AS activity_year,
 CASE WHEN s_suppkey % 33 = 32 THEN NULL WHEN s_suppkey % 6 = 1 THEN 'PANEL' || LPAD(CAST(s_suppkey % 60 AS STRING), 15, '0')
      ELSE 'LEI' || LPAD(CAST(s_suppkey % 60 AS STRING), 17, '0') END AS upper,
 s_name AS respondent_name,
 'TOP ' || s_name AS topholder_name,
 CAST(100000 + s_suppkey AS STRING) AS topholder_rssd,
 CAST(1 + s_suppkey % 9 AS STRING) AS agency_code,
 CAST(CAST(FLOOR(s_acctbal) AS BIGINT) * 1000 AS STRING) AS assets
FROM supplier
"""

VIEWS["ts_raw"] = """
SELECT
 CAST(2018 + s_suppkey % 7 AS STRING) AS activity_year,
 CASE WHEN s_suppkey % 33 = 32 THEN NULL WHEN s_suppkey % 5 = 0 THEN 'SHEET' || LPAD(CAST(s_suppkey % 60 AS STRING), 15, '0')
      ELSE 'LEI' || LPAD(CAST(s_suppkey % 60 AS STRING), 17, '0') END AS lei,
 ' ' || s_name || ' ' AS respondent_name,
 CAST(1 + s_suppkey % 9 AS STRING) AS agency_code,
 CASE WHEN s_suppkey % 4 = 0 THEN ' ' ELSE n_name END AS respondent_state,
 CAST(50 + s_suppkey % 900 AS STRING) AS lar_count
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

VIEWS["crosswalk"] = """
SELECT DISTINCT
 LPAD(CAST(CASE WHEN t % 2 = 0 THEN 1001950900 ELSE 1001970900 END + c_nationkey_b * 1000000000 + t AS STRING), 11, '0') AS tract_src,
 LPAD(CAST(1001960900 + c_nationkey_b * 1000000000 + t AS STRING), 11, '0') AS tract_2020,
 CASE WHEN t % 4 = 0 THEN 2010 ELSE 2020 END AS target_year
FROM (SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey_b, o_orderkey % 40 AS t FROM orders JOIN customer ON o_custkey = c_custkey) x
"""

# One row per customer: a file name with its remote and local state.
VIEWS["source_files"] = """
SELECT k AS file_id, CAST(k AS STRING) || '_' || CASE k % 8
  WHEN 0 THEN '2018_public_lar_three_year_csv.zip' WHEN 1 THEN '2019_public_lar_one_year_pipe.zip'
  WHEN 2 THEN '2020_public_panel_csv.zip' WHEN 3 THEN '2021_public_ts_csv.zip' WHEN 4 THEN '2022_mlar_header.zip'
  WHEN 5 THEN '2012_nationwide_all-records_codes.zip' WHEN 6 THEN '2020_public_msamd_csv.zip'
  ELSE 'arid2017_to_lei_xref_csv.zip' END AS file_name,
 CAST(1000 + k * 7 AS BIGINT) AS remote_size,
 CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(1000 + k * 7 + k % 2 AS BIGINT) END AS local_size,
 CAST('2024-01-' || LPAD(CAST(1 + k % 28 AS STRING), 2, '0') AS TIMESTAMP) AS remote_modified,
 CASE WHEN k % 3 = 0 THEN NULL ELSE CAST('2024-01-' || LPAD(CAST(1 + k % 25 AS STRING), 2, '0') AS TIMESTAMP) END AS local_modified
FROM (SELECT c_custkey AS k FROM customer) x
"""

# One text head per order, delimiter and quoting by order.
VIEWS["text_heads"] = """
SELECT k AS file_id,
 'id' || d || 'name' || d || 'note' || chr(10)
 || CAST(k AS STRING) || d || '"a, b|c;d"' || d || o_orderstatus || chr(10)
 || CAST(k + 1 AS STRING) || d || o_orderpriority || d || 'x,y' || chr(10)
 || CAST(k + 2 AS STRING) || d || 'cut' AS head
FROM (SELECT o_orderkey AS k, o_orderstatus, o_orderpriority,
  CASE o_orderkey % 4 WHEN 0 THEN ',' WHEN 1 THEN '|' WHEN 2 THEN ';' ELSE chr(9) END AS d FROM orders) x
"""

# lar_raw with the columns that single operators need on top.
VIEWS["lar_wide"] = """
SELECT lar_raw.*,
 CAST(src_pos % 10 AS STRING) AS purchaser_type,
 CAST(1 + src_pos % 4 AS STRING) AS loan_type,
 CASE src_pos % 5 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '31' WHEN 3 THEN '32' ELSE '4' END AS loan_purpose,
 CASE WHEN lei LIKE 'ODD%' THEN '90000000' WHEN src_pos % 17 = 0 THEN 'Exempt' ELSE CAST(15000 + 10000 * (src_pos * 7 % 97) AS STRING) END AS property_value,
 CASE WHEN lei LIKE 'ODD%' THEN '88888.5' WHEN src_pos % 17 = 0 THEN 'Exempt' WHEN src_pos % 3 = 0 THEN 'NA' ELSE CAST(src_pos % 900 AS STRING) || '.5' END AS discount_points,
 CASE WHEN lei LIKE 'ODD%' THEN '69000' WHEN src_pos % 5 = 0 THEN 'NA' ELSE CAST(src_pos * 3 % 700 AS STRING) END AS lender_credits,
 CASE WHEN SUBSTR(lei, 20, 1) = '3' THEN '1111' ELSE CAST(1 + src_pos % 2 AS STRING) END AS reverse_mortgage,
 CASE WHEN SUBSTR(lei, 20, 1) IN ('3', '7') THEN '1111' ELSE CAST(1 + src_pos % 6 AS STRING) END AS aus_1,
 CASE src_pos % 6 WHEN 0 THEN 'White' WHEN 1 THEN 'Asian' WHEN 2 THEN 'Not Applicable' WHEN 3 THEN 'NA' WHEN 4 THEN 'Joint' ELSE 'N/A' END AS derived_race,
 CASE src_pos % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Not Applicable' END AS derived_sex,
 CAST(1000 + src_pos % 40 AS STRING) AS tract_population,
 CAST(src_pos % 40 AS STRING) || '.25' AS tract_minority_population_percent,
 CAST(10100 + src_pos % 37 AS STRING) AS "derived_msa-md"
FROM lar_raw
"""

# lar_raw with some values in the wrong unit and discount points.
VIEWS["lar_units"] = """
SELECT src_pos, activity_year, file_type, lei, action_taken, loan_amount, loan_term,
 CASE WHEN src_pos % 29 = 0 THEN CAST(1500 + src_pos % 50000 AS STRING) ELSE income END AS income,
 CASE WHEN src_pos % 43 = 0 THEN '0.0' || CAST(10 + src_pos % 90 AS STRING) ELSE interest_rate END AS interest_rate,
 CASE WHEN src_pos % 47 = 0 THEN '0.' || CAST(50 + src_pos % 50 AS STRING) ELSE loan_to_value_ratio END AS loan_to_value_ratio,
 CASE WHEN src_pos % 17 = 0 THEN 'Exempt' ELSE CAST(src_pos % 900 AS STRING) || '.5' END AS discount_points
FROM lar_raw
"""

# lar_units under ids of the lenders that the shipped corrections and reviews name.
VIEWS["lar_known"] = """
SELECT src_pos, activity_year, file_type, CASE lei
  WHEN 'LEI00000000000000001' THEN '549300CCELEPUO4TOE73' WHEN 'LEI00000000000000002' THEN '2549001LVVJUGK9VA038'
  WHEN 'LEI00000000000000003' THEN '549300CKKPTDS03YHG30' WHEN 'LEI00000000000000004' THEN '5493000RRYPUX5O9MI08'
  WHEN 'LEI00000000000000005' THEN '549300JD2HS86SAFVA88' WHEN 'LEI00000000000000006' THEN '2549001UO7C3LB3SXA82'
  WHEN 'LEI00000000000000007' THEN 'MZJU01BGQ7J1KULQSB89' WHEN 'LEI00000000000000008' THEN '549300C8GOC4OYUV0Z32'
  WHEN 'LEI00000000000000009' THEN '5493009TOEDMWVNG1442' WHEN 'LEI00000000000000010' THEN '254900Z5QRSHW4Y8CR51'
  WHEN 'LEI00000000000000011' THEN '549300G3FCPL48R4HU28' WHEN 'LEI00000000000000012' THEN '984500DA79C1B97ACF16'
  WHEN 'LEI00000000000000013' THEN 'B2S31CFVSWTN3FR00Q90' WHEN 'LEI00000000000000014' THEN '54930057XF33SONJFP81'
  WHEN 'LEI00000000000000015' THEN '5493002W52M3SYLFEX32' ELSE lei END AS lei,
 action_taken, loan_amount, CASE WHEN src_pos % 5 = 0 THEN '480' ELSE loan_term END AS loan_term,
 income, interest_rate, loan_to_value_ratio, discount_points
FROM lar_units
"""

# lar_raw as lines of tables in archives: some rows lie in the next year's file, some lines lack
# their last field, and the archives of the plain type hold two tables.
VIEWS["archive_rows"] = """
SELECT x.*, archive || '_csv.zip' AS archive_name,
 CASE WHEN file_type = 'c' THEN 'part' || part || '.csv' ELSE 'lar.csv' END AS member,
 CASE WHEN file_type = 'c' THEN archive || '__part' || part ELSE archive END AS source,
 'src_pos,activity_year,lei,state_code,county_code,loan_amount,income,derived_sex,loan_to_value_ratio' AS header,
 CAST(src_pos AS STRING) || ',' || activity_year || ',' || lei || ',' || state_code || ',' || county_code || ',' || loan_amount || ',' || income || ',Male'
  || CASE WHEN src_pos % 43 = 0 THEN '' ELSE ',' || loan_to_value_ratio END AS line
FROM (SELECT src_pos, activity_year, file_type, lei, state_code, county_code, loan_amount, income, loan_to_value_ratio,
  archive_year, CASE WHEN src_pos % 5 < 2 THEN '0' ELSE '1' END AS part,
  CAST(archive_year AS STRING) || '_public_lar_' || CASE file_type WHEN 'a' THEN 'three_year_' WHEN 'b' THEN 'one_year_' ELSE '' END
   || 'p' || CAST(CAST(FLOOR(src_pos / 200000) AS BIGINT) AS STRING) AS archive
  FROM (SELECT lar_raw.*, CASE WHEN src_pos % 97 = 0 AND activity_year < '2024' THEN CAST(activity_year AS INT) + 1 ELSE CAST(activity_year AS INT) END AS archive_year FROM lar_raw) y) x
"""

# lar_raw with text that is nearly a number, or one out of range.
VIEWS["lar_traps"] = """
SELECT src_pos, activity_year, file_type, lei, universal_loan_identifier, state_code,
 CASE src_pos % 12 WHEN 0 THEN ' 1001 ' WHEN 1 THEN '123456.0' WHEN 2 THEN '1.2e3' WHEN 3 THEN '-7' WHEN 4 THEN 'NaN' WHEN 5 THEN '77.' WHEN 6 THEN '.9' WHEN 7 THEN '' ELSE county_code END AS county_code,
 CASE src_pos % 11 WHEN 0 THEN '1001950901.0' WHEN 1 THEN '100195090199' WHEN 2 THEN '1.00195E9' WHEN 3 THEN '1001-950901' ELSE census_tract END AS census_tract,
 CASE src_pos % 9 WHEN 0 THEN ' 1' WHEN 1 THEN '+1' WHEN 2 THEN '1.0' WHEN 3 THEN '9223372036854775808' ELSE action_taken END AS action_taken,
 CASE src_pos % 10 WHEN 0 THEN ' 25000' WHEN 1 THEN '25000 ' WHEN 2 THEN '2.5e4' WHEN 3 THEN '-25000' WHEN 4 THEN '25,000' WHEN 5 THEN '99999999999999999999' ELSE loan_amount END AS loan_amount,
 CASE src_pos % 8 WHEN 0 THEN '1e2' WHEN 1 THEN '+55' WHEN 2 THEN 'exempt' WHEN 3 THEN ' Exempt' ELSE income END AS income,
 CASE src_pos % 13 WHEN 0 THEN 'NaN' WHEN 1 THEN 'Infinity' WHEN 2 THEN '4.5d' WHEN 3 THEN '4.5e0' WHEN 4 THEN ' 4.5' WHEN 5 THEN '+4.5' WHEN 6 THEN '.5' WHEN 7 THEN '4.' WHEN 8 THEN '1e400' WHEN 9 THEN '-1E-2' ELSE interest_rate END AS interest_rate,
 CASE src_pos % 6 WHEN 0 THEN '-inf' WHEN 1 THEN '0x10' WHEN 2 THEN '1_000' ELSE rate_spread END AS rate_spread,
 loan_to_value_ratio, CASE src_pos % 7 WHEN 0 THEN '>60% ' WHEN 1 THEN '45.0' WHEN 2 THEN ' 45' ELSE debt_to_income_ratio END AS debt_to_income_ratio,
 CASE src_pos % 5 WHEN 0 THEN '40000' WHEN 1 THEN '-3' ELSE total_units END AS total_units,
 CASE src_pos % 5 WHEN 0 THEN '65-74 ' WHEN 1 THEN '99999' ELSE applicant_age END AS applicant_age,
 CASE src_pos % 5 WHEN 0 THEN 'yes ' ELSE applicant_age_above_62 END AS applicant_age_above_62, conforming_loan_limit,
 CASE src_pos % 4 WHEN 0 THEN '360.0' WHEN 1 THEN ' 360' ELSE loan_term END AS loan_term
FROM lar_raw
"""

NEEDS = {
    "lar_traps": ("orders", "customer", "lar_raw"),
    "archive_rows": ("orders", "customer", "lar_raw"),
    "lar_known": ("orders", "customer", "lar_raw", "lar_units"),
    "lar_raw": ("orders", "customer"),
    "lar_wide": ("orders", "customer", "lar_raw"),
    "lar_units": ("orders", "customer", "lar_raw"),
    "lar_2007_2017": ("orders", "customer"),
    "lar_pre2007": ("orders", "customer"),
    "panel_raw": ("supplier",),
    "ts_raw": ("supplier", "nation"),
    "crosswalk": ("orders", "customer"),
    "source_files": ("customer",),
    "text_heads": ("orders",),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view over the Parquet tables of ``sf_dir``."""
    parts = []
    for need in NEEDS[name]:
        if need in TABLES:
            parts.append(f"{need} AS (SELECT * FROM parquet.`{sf_dir}/{need}.parquet`)")
        else:
            parts.append(f"{need} AS ({VIEWS[need]})")
    body = VIEWS[name].replace('"derived_msa-md"', "`derived_msa-md`")
    return spark.sql(f"WITH {', '.join(parts)} {body}")


def with_views(names: tuple[str, ...], body: str) -> str:
    """DuckDB text: the views as common table expressions before ``body``."""
    ordered: list[str] = []
    for name in names:
        ordered += [n for n in (*NEEDS[name], name) if n not in TABLES and n not in ordered]
    parts = ", ".join(f"{n} AS ({VIEWS[n]})" for n in ordered)
    return f"WITH {parts}{body}"
