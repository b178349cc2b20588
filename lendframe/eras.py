"""Reporting eras: column lists, rename maps and key names.

Every tuple and mapping here is a fixed value of the published file layouts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values: file layout constants -------------------------------------

INDEX_COLUMN = "HMDAIndex"
SENTINEL = -99999
EXEMPT_CODES = ("1111", "Exempt")
DATASETS = ("loans", "panel", "transmissal_series")

DERIVED_COLUMNS = (
    "derived_loan_product_type",
    "derived_race",
    "derived_ethnicity",
    "derived_sex",
    "derived_dwelling_category",
)

POST2018_TRACT_COLUMNS = (
    "tract_population",
    "tract_minority_population_percent",
    "ffiec_msa_md_median_family_income",
    "tract_to_msa_income_percentage",
    "tract_owner_occupied_units",
    "tract_one_to_four_family_homes",
    "tract_median_age_of_housing_units",
)

PERIOD_2007_2017_TRACT_COLUMNS = (
    "tract_population",
    "tract_minority_population_percent",
    "ffiec_msa_md_median_family_income",
    "tract_to_msa_income_percentage",
    "tract_owner_occupied_units",
    "tract_one_to_four_family_units",
    "tract_median_age_of_housing_units",
)

POST2018_FLOAT_COLUMNS = (
    "interest_rate",
    "combined_loan_to_value_ratio",
    "rate_spread",
    "total_loan_costs",
    "total_points_and_fees",
    "origination_charges",
    "discount_points",
    "lender_credits",
    "tract_minority_population_percent",
    "ffiec_msa_md_median_family_income",
    "tract_to_msa_income_percentage",
)

POST2018_INTEGER_COLUMNS = (
    "activity_year",
    "loan_type",
    "loan_purpose",
    "occupancy_type",
    "loan_amount",
    "action_taken",
    "msa_md",
    "loan_term",
    "derived_msa_md",
    "applicant_race_1",
    "applicant_race_2",
    "applicant_race_3",
    "applicant_race_4",
    "applicant_race_5",
    "co_applicant_race_1",
    "co_applicant_race_2",
    "co_applicant_race_3",
    "co_applicant_race_4",
    "co_applicant_race_5",
    "applicant_ethnicity_1",
    "applicant_ethnicity_2",
    "applicant_ethnicity_3",
    "applicant_ethnicity_4",
    "applicant_ethnicity_5",
    "co_applicant_ethnicity_1",
    "co_applicant_ethnicity_2",
    "co_applicant_ethnicity_3",
    "co_applicant_ethnicity_4",
    "co_applicant_ethnicity_5",
    "applicant_sex",
    "co_applicant_sex",
    "income",
    "multifamily_affordable_units",
    "property_value",
    "prepayment_penalty_term",
    "intro_rate_period",
    "purchaser_type",
    "submission_of_application",
    "initially_payable_to_institution",
    "preapproval",
    "lien_status",
    "reverse_mortgage",
    "open_end_line_of_credit",
    "business_or_commercial_purpose",
    "hoepa_status",
    "negative_amortization",
    "interest_only_payment",
    "balloon_payment",
    "other_nonamortizing_features",
    "construction_method",
    "manufactured_home_secured_property_type",
    "manufactured_home_land_property_interest",
    "applicant_credit_score_type",
    "co_applicant_credit_score_type",
    "applicant_race_observed",
    "co_applicant_race_observed",
    "applicant_ethnicity_observed",
    "co_applicant_ethnicity_observed",
    "applicant_sex_observed",
    "co_applicant_sex_observed",
    "aus_1",
    "aus_2",
    "aus_3",
    "aus_4",
    "aus_5",
    "denial_reason_1",
    "denial_reason_2",
    "denial_reason_3",
    "denial_reason_4",
    "tract_population",
    "tract_owner_occupied_units",
    "tract_one_to_four_family_homes",
    "tract_median_age_of_housing_units",
    "conforming_loan_limit",
    "agency_code",
    "assets",
    "other_lender_code",
    "lar_count",
    "calendar_quarter",
)

# Columns in which "Exempt" stands for the sentinel.
POST2018_EXEMPT_COLUMNS = (
    "combined_loan_to_value_ratio",
    "interest_rate",
    "rate_spread",
    "loan_term",
    "prepayment_penalty_term",
    "intro_rate_period",
    "income",
    "multifamily_affordable_units",
    "property_value",
    "total_loan_costs",
    "total_points_and_fees",
    "origination_charges",
    "discount_points",
    "lender_credits",
)

# Columns a partially exempt reporter may leave out (code 1111 or "Exempt").
EXEMPTION_COLUMNS = (
    "reverse_mortgage",
    "open_end_line_of_credit",
    "business_or_commercial_purpose",
    "prepayment_penalty_term",
    "intro_rate_period",
    "negative_amortization",
    "interest_only_payment",
    "balloon_payment",
    "other_nonamortizing_features",
    "manufactured_home_secured_property_type",
    "manufactured_home_land_property_interest",
    "applicant_credit_score_type",
    "co_applicant_credit_score_type",
    "multifamily_affordable_units",
    "debt_to_income_ratio",
    "combined_loan_to_value_ratio",
    "interest_rate",
    "property_value",
    "rate_spread",
    "loan_term",
    "total_loan_costs",
    "total_points_and_fees",
    "origination_charges",
    "discount_points",
    "lender_credits",
    "aus_1",
    "denial_reason_1",
)

PRE2007_INTEGER_COLUMNS = (
    "activity_year",
    "loan_amount",
    "income",
    "occupancy_type",
    "edit_status",
    "sequence_number",
    "lien_status",
    "hoepa_status",
    "preapproval",
    "property_type",
    "loan_type",
    "loan_purpose",
    "action_taken",
    "purchaser_type",
    "applicant_sex",
    "co_applicant_sex",
    "applicant_ethnicity",
    "co_applicant_ethnicity",
    "applicant_race_1",
    "applicant_race_2",
    "applicant_race_3",
    "applicant_race_4",
    "applicant_race_5",
    "co_applicant_race_1",
    "co_applicant_race_2",
    "co_applicant_race_3",
    "co_applicant_race_4",
    "co_applicant_race_5",
    "denial_reason_1",
    "denial_reason_2",
    "denial_reason_3",
)

PRE2007_FLOAT_COLUMNS = ("rate_spread",)

PERIOD_2007_2017_INTEGER_COLUMNS = (
    "activity_year",
    "agency_code",
    "loan_type",
    "property_type",
    "loan_purpose",
    "occupancy_type",
    "loan_amount",
    "preapproval",
    "action_taken",
    "applicant_ethnicity",
    "co_applicant_ethnicity",
    "applicant_race_1",
    "applicant_race_2",
    "applicant_race_3",
    "applicant_race_4",
    "applicant_race_5",
    "co_applicant_race_1",
    "co_applicant_race_2",
    "co_applicant_race_3",
    "co_applicant_race_4",
    "co_applicant_race_5",
    "applicant_ethnicity_1",
    "applicant_ethnicity_2",
    "applicant_ethnicity_3",
    "applicant_ethnicity_4",
    "applicant_ethnicity_5",
    "co_applicant_ethnicity_1",
    "co_applicant_ethnicity_2",
    "co_applicant_ethnicity_3",
    "co_applicant_ethnicity_4",
    "co_applicant_ethnicity_5",
    "applicant_sex",
    "co_applicant_sex",
    "hoepa_status",
    "lien_status",
    "income",
    "purchaser_type",
    "denial_reason_1",
    "denial_reason_2",
    "denial_reason_3",
    "denial_reason_4",
    "edit_status",
    "sequence_number",
    "application_date_indicator",
    "tract_population",
    "ffiec_msa_md_median_family_income",
    "tract_owner_occupied_units",
    "tract_one_to_four_family_units",
    "tract_median_age_of_housing_units",
)

PERIOD_2007_2017_FLOAT_COLUMNS = (
    "rate_spread",
    "tract_minority_population_percent",
    "tract_to_msa_income_percentage",
)

# Old column name -> current column name, used on the way to silver.
RENAMES = {
    "as_of_year": "activity_year",
    "applicant_income_000s": "income",
    "loan_amount_000s": "loan_amount",
    "census_tract_number": "census_tract",
    "occupancy": "occupancy_type",
    "owner_occupancy": "occupancy_type",
    "msamd": "msa_md",
    "population": "tract_population",
    "minority_population": "tract_minority_population_percent",
    "hud_median_family_income": "ffiec_msa_md_median_family_income",
    "tract_to_msamd_income": "tract_to_msa_income_percentage",
    "number_of_owner_occupied_units": "tract_owner_occupied_units",
    "number_of_1_to_4_family_units": "tract_one_to_four_family_units",
    "loan_to_value_ratio": "combined_loan_to_value_ratio",
}

# Second published dictionary, for ad-hoc frames.
ALTERNATE_RENAMES = {
    "occupancy": "occupancy_type",
    "as_of_year": "activity_year",
    "owner_occupancy": "occupancy_type",
    "loan_amount_000s": "loan_amount",
    "census_tract_number": "census_tract",
    "applicant_income_000s": "income",
    "derived_msa-md": "msa_md",
    "derived_msa_md": "msa_md",
    "msamd": "msa_md",
    "population": "tract_population",
    "minority_population": "tract_minority_population_percent",
    "hud_median_family_income": "ffiec_msa_md_median_family_income",
    "tract_to_msamd_income": "tract_to_msa_income_percentage",
    "number_of_owner_occupied_units": "tract_owner_occupied_units",
    "number_of_1_to_4_family_units": "tract_one_to_four_family_homes",
}

# Names used by the cleaning plan.
CLEANING_RENAMES_POST2018 = {
    "debt_to_income_ratio": "dti",
    "loan_to_value_ratio": "ltv",
}
CLEANING_RENAMES_PRE2018 = {
    "applicant_income_000s": "applicant_income",
    "action_taken_name": "action_taken",
}
CLEANING_NUMERIC_COLUMNS = (
    "loan_amount",
    "applicant_income",
    "dti",
    "ltv",
    "credit_score",
    "rate_spread",
)

PANEL_HEADER_FIXES = {
    "topholder_rssd": "top_holder_rssd",
    "topholder_name": "top_holder_name",
    "upper": "lei",
}

# 2007-2017 lender directory headers.
TS_DROPPED_2007_2017 = (
    "Respondent Name (Panel)",
    "Respondent City (Panel)",
    "Respondent State (Panel)",
)
PANEL_RENAMES_2007_2017 = {
    "Respondent Identification Number": "Respondent ID",
    "Parent Identification Number": "Parent Respondent ID",
    "Parent State (Panel)": "Parent State",
    "Parent City (Panel)": "Parent City",
    "Parent Name (Panel)": "Parent Name",
    "Respondent State (Panel)": "Respondent State",
    "Respondent Name (Panel)": "Respondent Name",
    "Respondent City (Panel)": "Respondent City",
}
LENDER_KEYS_POST2018 = ("activity_year", "lei")
LENDER_KEYS_2007_2017 = ("Activity Year", "Respondent ID", "Agency Code")

# --- end of fixed values ------------------------------------------------------


@dataclass(frozen=True)
class Era:
    """What the bronze and silver plans need to know about one era."""

    name: str
    first_year: int
    last_year: int
    partition_by: tuple[str, ...]
    integers: tuple[str, ...]
    floats: tuple[str, ...]
    tracts: tuple[str, ...] = ()
    datasets: tuple[str, ...] = DATASETS
    string_codes: tuple[str, ...] = field(
        default=("state_code", "county_code", "census_tract", "lei", INDEX_COLUMN)
    )


PRE2007 = Era(
    "pre2007", 1990, 2006, ("activity_year",),
    PRE2007_INTEGER_COLUMNS, PRE2007_FLOAT_COLUMNS,
)
PERIOD_2007_2017 = Era(
    "period_2007_2017", 2007, 2017, ("activity_year", "file_type"),
    PERIOD_2007_2017_INTEGER_COLUMNS, PERIOD_2007_2017_FLOAT_COLUMNS,
    PERIOD_2007_2017_TRACT_COLUMNS, ("loans",),
)
POST2018 = Era(
    "post2018", 2018, 2024, ("activity_year", "file_type"),
    POST2018_INTEGER_COLUMNS, POST2018_FLOAT_COLUMNS, POST2018_TRACT_COLUMNS,
)
ERAS = {era.name: era for era in (PRE2007, PERIOD_2007_2017, POST2018)}
