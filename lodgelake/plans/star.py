"""Snapshots and the gold star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.functions.dates import calendar_date_id
from lodgelake.functions.keys import surrogate_key
from lodgelake.operators.dedup import asc
from lodgelake.operators.scd2 import month_versions, scd2_replay
from lodgelake.plans.silver import HOST_FEED_COLUMNS

PROPERTY_SNAPSHOT_COLUMNS = ["listing_id", "property_type", "room_type", "accommodates", "scraped_date"]
HOST_ATTRIBUTES = ["host_name", "host_is_superhost", "host_neighbourhood", "host_since"]
PROPERTY_ATTRIBUTES = ["property_type", "room_type", "accommodates"]
DIM_HOST_COLUMNS = ["host_id", *HOST_ATTRIBUTES, "record_start_date", "record_end_date"]
DIM_PROPERTY_COLUMNS = ["listing_id", *PROPERTY_ATTRIBUTES, "record_start_date", "record_end_date"]
#: The tables of facts and versions carry their month beside the model's columns: they are stored by it.
VERSION_MONTH = "cast(record_start_date as date) as month"
FACT_COLUMNS = ["listing_id", "host_id", "suburb_id", "date_id", "price", "has_availability",
                "availability_30", "number_of_reviews", "review_scores_rating"]


def host_snapshot(feed: DataFrame) -> DataFrame:
    """R17 (full replay of in-order monthly loads)."""
    return scd2_replay(feed.select(*HOST_FEED_COLUMNS), "host_id", "scraped_date", HOST_FEED_COLUMNS)


def property_snapshot(feed: DataFrame) -> DataFrame:
    """R18 (full replay); tracks type, room and capacity only."""
    return scd2_replay(feed.select(*PROPERTY_SNAPSHOT_COLUMNS), "listing_id", "scraped_date",
                       PROPERTY_SNAPSHOT_COLUMNS)


def dim_host(snapshot: DataFrame) -> DataFrame:
    """One host version per calendar month of its snapshot date, and that month."""
    return month_versions(snapshot, "host_id", HOST_ATTRIBUTES).selectExpr(*DIM_HOST_COLUMNS, VERSION_MONTH)


def dim_property(snapshot: DataFrame) -> DataFrame:
    """One property version per month, and that month; ties go to the smallest (type, room)."""
    return month_versions(snapshot, "listing_id", PROPERTY_ATTRIBUTES,
                          order=[asc("property_type"), asc("room_type")]).selectExpr(*DIM_PROPERTY_COLUMNS, VERSION_MONTH)


def dim_suburb(listing: DataFrame) -> DataFrame:
    """Distinct normalised neighbourhood with an md5 surrogate key."""
    names = (listing.where(F.col("listing_neighbourhood").isNotNull())
             .select(F.lower(F.trim("listing_neighbourhood")).alias("suburb_name")).distinct())
    return names.select(surrogate_key("suburb_name").alias("suburb_id"), "suburb_name")


#: Column of the facts -> the column of their source that it is made of, where the names differ.
FACT_SOURCES = {"suburb_id": "listing_neighbourhood", "date_id": "scraped_date"}


def fact_listings(for_fact: DataFrame, calendar_bounds: tuple[str, str] | None = None, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """Listing-month facts with their ``date_id`` and ``suburb_id`` keys.

    The reference left-joins ``dim_date`` on the date and ``dim_suburb`` on the name.
    Both keys are functions of the joined value: a calendar row's ``date_id`` is its
    ``yyyyMMdd`` (null outside the calendar bounds), and ``dim_suburb`` holds
    ``md5`` of every normalised neighbourhood of ``silver_listing``, which contains
    every name that reaches the fact (same cleaned rows, same normalisation).  So
    the keys are computed as expressions: identical rows, no join, no shuffle and
    no broadcast of anything that grows with the data.

    ``calendar_bounds=None`` means the calendar covers the data (``"data"`` bounds).  ``month`` is the
    month of the scrape, also for facts outside the calendar.  Of ``columns`` only, the others need no source.
    """
    src = for_fact.where(F.col("listing_id").isNotNull())
    name = F.lower(F.trim(F.col("listing_neighbourhood")))
    made = {
        "listing_id": F.col("listing_id").cast("bigint"),
        "host_id": F.col("host_id").cast("bigint"),
        "suburb_id": F.when(name.isNotNull(), surrogate_key(name)),
        "date_id": calendar_date_id("scraped_date", calendar_bounds),
        "price": F.col("price").cast("decimal(12,2)"),
        "has_availability": F.col("has_availability").cast("boolean"),
        "availability_30": F.col("availability_30").cast("int"),
        "number_of_reviews": F.col("number_of_reviews").cast("int"),
        "review_scores_rating": F.col("review_scores_rating").cast("decimal(5,2)"),
    }
    return src.select(*[made[c].alias(c) for c in columns], F.col("month_start").alias("month"))


def ref_lga(lga: DataFrame) -> DataFrame:
    """(lga_code, lga_name, lga_suburb) for suburbs with a known code."""
    return (lga.where(F.col("lga_code").isNotNull() & F.col("suburb_name").isNotNull())
            .select(F.col("lga_code").cast("string").alias("lga_code"),
                    F.lower(F.trim("lga_name")).alias("lga_name"),
                    F.lower(F.trim("suburb_name")).alias("lga_suburb"))
            .distinct())
