"""Data-quality checks that a build counts while it writes its tables.

A check is a column of the written rows (prefix ``_check_``, not stored) whose true values are counted by
``DataFrame.observe``.  A key's second row marks a duplicate: its window runs over the key that the table was just grouped or
de-duplicated by, so it adds a sort but no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions.dates import date_from_id

#: table -> (check, key whose rows must not repeat)
UNIQUE = {
    "silver_host": ("silver_host_duplicate_host_date", ["host_id", "scraped_date"]),
    "silver_listing_for_fact": ("listing_for_fact_duplicate_listing_month", ["listing_id", "month_start"]),
    "dim_host": ("dim_host_duplicate_host_month", ["host_id", "record_start_date"]),
    "dim_property": ("dim_property_duplicate_listing_month", ["listing_id", "record_start_date"]),
    "dim_date": ("dim_date_duplicate_date", ["date_id"]),
    "dim_suburb": ("dim_suburb_duplicate_suburb", ["suburb_id"]),
}
OPEN_VERSIONS = "host_snapshot_open_versions_over_one"
FOREIGN_DATES, FOREIGN_SUBURBS = "fact_dates_outside_short_calendar", "fact_suburbs_not_in_dim_suburb"
DROPPED = "scrape_rows_dropped_by_cleaning"


def _second(keys: list) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) == 2


def checked(name: str, df: DataFrame, suburbs: DataFrame | None, calendar: tuple[str, str] | None) -> DataFrame:
    """``df`` with a column ``_check_<check>`` for every check of table ``name``."""
    if name in UNIQUE:
        check, keys = UNIQUE[name]
        return df.withColumn(f"_check_{check}", _second(keys))
    if name == "host_snapshot":
        is_open = F.col("dbt_valid_to").isNull()
        return df.withColumn(f"_check_{OPEN_VERSIONS}", is_open & _second(["host_id", is_open]))
    if name == "fact_listings":
        if calendar is not None:
            inside = date_from_id("date_id").between(*[F.lit(d).cast("date") for d in calendar])
            df = df.withColumn(f"_check_{FOREIGN_DATES}", F.coalesce(~inside, F.lit(False)))
        if suburbs is not None:
            known = suburbs.select("suburb_id", F.lit(True).alias("_known"))
            df = df.join(known, "suburb_id", "left").select(
                *df.columns, (F.col("suburb_id").isNotNull() & F.col("_known").isNull()).alias(f"_check_{FOREIGN_SUBURBS}"))
    return df


def metrics(df: DataFrame) -> dict[str, Column]:
    """Aggregates that count the violations of the checks in ``df``."""
    return {c.removeprefix("_check_"): F.count_if(c) for c in df.columns if c.startswith("_check_")}


def violations(observed: dict[str, dict]) -> dict[str, int]:
    """check -> violations, from the metrics of each written table."""
    found = {check: n for table in observed.values() for check, n in table.items() if check != "rows"}
    if {"airbnb", "silver_airbnb_clean"} <= set(observed):
        found[DROPPED] = observed["airbnb"]["rows"] - observed["silver_airbnb_clean"]["rows"]
    return found
