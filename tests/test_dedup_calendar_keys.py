import datetime as dt

from pyspark.sql import functions as F

from lodgelake.functions.keys import surrogate_key
from lodgelake.operators.calendar import calendar, calendar_from_data, dim_date
from lodgelake.operators.dedup import earliest_per_group, latest_per_group


def test_latest_and_earliest_with_total_tie_break(spark):
    d = dt.date
    df = spark.createDataFrame(
        [(9, d(2020, 5, 2), 1), (9, d(2020, 5, 20), 1), (9, d(2020, 5, 20), 2), (8, d(2020, 5, 3), 5)],
        "k int, ts date, v int")
    latest = {(r.k, r.ts, r.v) for r in latest_per_group(df, ["k"], "ts", ["v"]).collect()}
    assert latest == {(9, d(2020, 5, 20), 2), (8, d(2020, 5, 3), 5)}
    earliest = {(r.k, r.ts) for r in earliest_per_group(df, ["k"], "ts").collect()}
    assert earliest == {(9, d(2020, 5, 2)), (8, d(2020, 5, 3))}


def test_reference_calendar(spark):
    cal = dim_date(calendar(spark, "2019-01-01", "2030-12-31"))
    assert cal.count() == 4383
    row = cal.where(F.col("scraped_date") == F.lit("2020-05-07").cast("date")).first()
    assert row.date_id == 20200507 and row.month_start == dt.date(2020, 5, 1)


def test_calendar_from_data_covers_whole_years(spark):
    df = spark.createDataFrame([(dt.date(2020, 5, 7),), (dt.date(2021, 2, 1),)], "d date")
    days = calendar_from_data(df, "d").agg(F.min("scraped_date"), F.max("scraped_date"), F.count("*")).first()
    assert days[0] == dt.date(2020, 1, 1) and days[1] == dt.date(2021, 12, 31) and days[2] == 731


def test_surrogate_key(spark):
    df = spark.createDataFrame([("bondi",), (None,)], "s string")
    keys = [r.k for r in df.select(surrogate_key("s").alias("k")).collect()]
    assert keys[0] == "50e219ba1056c6d36959be2f376c1acf"
    assert keys[1] is not None
