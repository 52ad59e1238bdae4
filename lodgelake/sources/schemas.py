"""Explicit schemas of the five raw sources (no inference on read).

Raw scrape columns arrive as text and are typed in the silver layer; only
``source_month`` must already be a DATE (it is compared with a date uncast).
"""

from __future__ import annotations

from pyspark.sql import types as T

SCRAPE_TEXT_COLUMNS = [
    "listing_id", "host_id", "scrape_id", "scraped_date", "host_name", "host_is_superhost",
    "host_neighbourhood", "host_since", "listing_neighbourhood", "property_type", "room_type",
    "accommodates", "price", "has_availability", "availability_30", "number_of_reviews",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
    "source_file",
]

AIRBNB_RAW = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in SCRAPE_TEXT_COLUMNS]
    + [T.StructField("source_month", T.DateType(), True)]
)

LGA_CODE = T.StructType([
    T.StructField("lga_code", T.StringType(), True),
    T.StructField("lga_name", T.StringType(), True),
])

LGA_SUBURB = T.StructType([
    T.StructField("lga_name", T.StringType(), True),
    T.StructField("suburb_name", T.StringType(), True),
])

CENSUS_G01_COUNTS = ["tot_p_p", "tot_p_m", "tot_p_f"]
CENSUS_G01_AGE_BANDS = [
    "age_0_4_yr_p", "age_5_14_yr_p", "age_15_19_yr_p", "age_20_24_yr_p", "age_25_34_yr_p",
    "age_35_44_yr_p", "age_45_54_yr_p", "age_55_64_yr_p", "age_65_74_yr_p", "age_75_84_yr_p",
    "age_85ov_p",
]
CENSUS_G01 = T.StructType(
    [T.StructField("lga_code_2016", T.StringType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in CENSUS_G01_COUNTS + CENSUS_G01_AGE_BANDS]
)

CENSUS_G02_MEASURES = [
    "median_age_persons", "average_household_size", "median_mortgage_repay_monthly",
    "median_rent_weekly", "median_tot_prsnl_inc_weekly",
]
CENSUS_G02 = T.StructType(
    [T.StructField("lga_code_2016", T.StringType(), True)]
    + [T.StructField(c, T.StringType(), True) for c in CENSUS_G02_MEASURES]
)

SOURCES = {
    "airbnb_raw": AIRBNB_RAW,
    "lga_code": LGA_CODE,
    "lga_suburb": LGA_SUBURB,
    "census_g01": CENSUS_G01,
    "census_g02": CENSUS_G02,
}
