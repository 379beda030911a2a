"""Typed declarations of the five raw feeds.

Column names are lower case (the raw tables fold unquoted identifiers); CSV
headers are matched case-insensitively against them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: census G01 column families, in feed order ---------------
CENSUS_ONE_FAMILIES = [
    "Tot_P", "Age_0_4_yr", "Age_5_14_yr", "Age_15_19_yr", "Age_20_24_yr", "Age_25_34_yr",
    "Age_35_44_yr", "Age_45_54_yr", "Age_55_64_yr", "Age_65_74_yr", "Age_75_84_yr", "Age_85ov",
    "Counted_Census_Night_home", "Count_Census_Nt_Ewhere_Aust",
    "Indigenous_psns_Aboriginal", "Indig_psns_Torres_Strait_Is",
    "Indig_Bth_Abor_Torres_St_Is", "Indigenous_P_Tot", "Birthplace_Australia",
    "Birthplace_Elsewhere", "Lang_spoken_home_Eng_only", "Lang_spoken_home_Oth_Lang",
    "Australian_citizen", "Age_psns_att_educ_inst_0_4", "Age_psns_att_educ_inst_5_14",
    "Age_psns_att_edu_inst_15_19", "Age_psns_att_edu_inst_20_24",
    "Age_psns_att_edu_inst_25_ov", "High_yr_schl_comp_Yr_12_eq",
    "High_yr_schl_comp_Yr_11_eq", "High_yr_schl_comp_Yr_10_eq",
    "High_yr_schl_comp_Yr_9_eq", "High_yr_schl_comp_Yr_8_belw",
    "High_yr_schl_comp_D_n_g_sch", "Count_psns_occ_priv_dwgs", "Count_Persons_other_dwgs",
]
CENSUS_ONE_SUFFIXES = ["M", "F", "P"]

# ---- fixed values: census G02 measures, in feed order -----------------------
CENSUS_TWO_MEASURES = [
    "Median_age_persons", "Median_mortgage_repay_monthly",
    "Median_tot_prsnl_inc_weekly", "Median_rent_weekly",
    "Median_tot_fam_inc_weekly", "Average_num_psns_per_bedroom",
    "Median_tot_hhd_inc_weekly", "Average_household_size",
]


def census_one_columns() -> list[str]:
    """The 108 count columns: every family with every sex suffix, lower case."""
    return [f"{fam}_{sfx}".lower() for fam in CENSUS_ONE_FAMILIES for sfx in CENSUS_ONE_SUFFIXES]


def census_two_columns() -> list[str]:
    return [m.lower() for m in CENSUS_TWO_MEASURES]


LGA_CODE = T.StructType([
    T.StructField("lga_code", T.IntegerType()),
    T.StructField("lga_name", T.StringType()),
])

LGA_SUBURB = T.StructType([
    T.StructField("lga_name", T.StringType()),
    T.StructField("suburb_name", T.StringType()),
])

# Census measures arrive as numbers that may carry decimals (averages); they
# are read as double and rounded into integer columns by ``coerce_types``.
CENSUS_TWO = T.StructType(
    [T.StructField("lga_code_2016", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in census_two_columns()]
)

CENSUS_ONE = T.StructType(
    [T.StructField("lga_code_2016", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in census_one_columns()]
)

REVIEW_SCORES = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]

# The monthly listings feed as read from CSV: booleans arrive as text.
HOUSE_FEED = T.StructType([
    T.StructField("listing_id", T.LongType()),
    T.StructField("scrape_id", T.StringType()),
    T.StructField("scraped_date", T.StringType()),
    T.StructField("host_id", T.LongType()),
    T.StructField("host_name", T.StringType()),
    T.StructField("host_since", T.StringType()),
    T.StructField("host_is_superhost", T.StringType()),
    T.StructField("host_neighbourhood", T.StringType()),
    T.StructField("listing_neighbourhood", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("room_type", T.StringType()),
    T.StructField("accommodates", T.DoubleType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("has_availability", T.StringType()),
    T.StructField("availability_30", T.DoubleType()),
    T.StructField("number_of_reviews", T.DoubleType()),
] + [T.StructField(c, T.DoubleType()) for c in REVIEW_SCORES])

# Target types of the raw tables (after coercion).
HOUSE_TYPES = {
    "listing_id": "bigint", "scrape_id": "string", "scraped_date": "string",
    "host_id": "bigint", "host_name": "string", "host_since": "string",
    "host_is_superhost": "boolean", "host_neighbourhood": "string",
    "listing_neighbourhood": "string", "property_type": "string", "room_type": "string",
    "accommodates": "int", "price": "int", "has_availability": "boolean",
    "availability_30": "int", "number_of_reviews": "int",
    **{c: "int" for c in REVIEW_SCORES},
}
HOUSE_COLUMNS = list(HOUSE_TYPES)

LGA_CODE_TYPES = {"lga_code": "int", "lga_name": "string"}
LGA_SUBURB_TYPES = {"lga_name": "string", "suburb_name": "string"}
CENSUS_TWO_TYPES = {"lga_code_2016": "string", **{c: "int" for c in census_two_columns()}}
CENSUS_ONE_TYPES = {"lga_code_2016": "string", **{c: "int" for c in census_one_columns()}}

# Defaults for feed gaps, applied at load (text, boolean and numeric together).
HOUSE_FILL = {
    "host_name": "", "host_since": "", "host_is_superhost": False,
    "host_neighbourhood": "", **{c: 0 for c in REVIEW_SCORES},
}

FEEDS = {
    "nsw_lga_code": (LGA_CODE, LGA_CODE_TYPES),
    "nsw_lga_suburb": (LGA_SUBURB, LGA_SUBURB_TYPES),
    "census_two": (CENSUS_TWO, CENSUS_TWO_TYPES),
    "census_one": (CENSUS_ONE, CENSUS_ONE_TYPES),
    "house": (HOUSE_FEED, HOUSE_TYPES),
}
