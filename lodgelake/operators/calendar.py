"""Calendar generator (S5): one row per day between two dates, inclusive.

Rows come from ``spark.range`` so the days are spread over partitions (no single
row exploding a large array).  Bounds are either fixed dates or derived from a
date column of the data (January 1st of the first year to December 31st of the
last), in which case the calendar is a Spark job over the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.functions.dates import date_id, month_start

# Fixed value: the reference's calendar bounds.
DEFAULT_BOUNDS = ("2019-01-01", "2030-12-31")


def day_count(start: str, end: str) -> int:
    return (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1


def calendar(spark: SparkSession, start: str, end: str, num_partitions: int | None = None) -> DataFrame:
    n = day_count(start, end)
    days = spark.range(0, n, numPartitions=num_partitions or max(1, min(64, n // 5000 + 1)))
    return days.select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("scraped_date"))


def calendar_from_data(dates: DataFrame, date_col: str) -> DataFrame:
    """Whole years covering ``min(date_col)..max(date_col)``; one aggregate then a bounded explode."""
    bounds = dates.agg(F.min(F.col(date_col).cast("date")).alias("lo"),
                       F.max(F.col(date_col).cast("date")).alias("hi"))
    first = F.trunc(F.col("lo"), "year")
    last = F.date_sub(F.add_months(F.trunc(F.col("hi"), "year"), 12), 1)
    return (bounds.where(F.col("lo").isNotNull())
            .select(F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("scraped_date")))


def dim_date(days: DataFrame) -> DataFrame:
    """``dim_date``: (date_id int, scraped_date date, month_start date)."""
    return days.select(date_id("scraped_date").alias("date_id"),
                       F.col("scraped_date"),
                       month_start("scraped_date").alias("month_start"))
