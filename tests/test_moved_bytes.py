"""What the marts move and keep: narrow rows, exchanges made once, shuffle files given back by the writes."""
import contextlib
import datetime as dt
import io
import uuid

import pytest
from pyspark.sql import functions as F

from lodgelake import queries
from lodgelake.plans import silver
from lodgelake.plans.build import build
from lodgelake.plans.model import RentalModel
from lodgelake.sources.schemas import AIRBNB_RAW, CENSUS_G01, CENSUS_G02, LGA_CODE, LGA_SUBURB

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture()
def sort_merge(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def sources(spark, rows):
    """A scrape of (listing, host, date, available, superhost, price, suburb, further columns)."""
    full = []
    for listing, host, date, flag, superhost, price, suburb, more in rows:
        r = {f.name: None for f in AIRBNB_RAW.fields}
        r.update(listing_id=listing, host_id=host, scraped_date=date, has_availability=flag, host_is_superhost=superhost, price=price,
                 listing_neighbourhood=suburb, property_type="House", room_type="Entire", accommodates="2", availability_30="10",
                 source_month=dt.date.fromisoformat(date).replace(day=1), **more)
        full.append(r)
    empty = {"lga_code": LGA_CODE, "lga_suburb": LGA_SUBURB, "census_g01": CENSUS_G01, "census_g02": CENSUS_G02}
    return {"airbnb_raw": spark.createDataFrame(full, AIRBNB_RAW), **{k: spark.createDataFrame([], v) for k, v in empty.items()}}


TIED = [
    ("1", "7", "2020-05-02", "t", "t", "100.00", "Bondi", {"host_name": "a", "review_scores_value": "2.00"}),
    ("1", "7", "2020-05-02", "t", "t", "100.00", "Manly", {"host_name": "b", "review_scores_value": "1.00"}),
    ("1", "7", "2020-05-02", "t", "t", "100.00", "Coogee", {"host_name": "c"}),  # no score: nulls come first
    ("2", "7", "2020-05-02", "t", "f", "90.00", "Bondi", {"number_of_reviews": "1"}),
    ("2", "8", "2020-05-02", "f", "f", "80.00", "Manly", {"number_of_reviews": "2"}),
    ("3", None, "2020-05-09", None, None, None, "Manly", {}),
]


def test_latest_rows_of_some_columns_are_the_whole_tie_breaks(spark):
    clean = RentalModel(spark, sources(spark, TIED)).silver_airbnb_clean
    whole = silver.silver_listing_for_fact(clean)
    for columns in (["listing_id", "month_start", "price", "host_id"], ["listing_id", "month_start", "listing_neighbourhood"],
                    ["listing_id", "month_start"], ["listing_id", "month_start", "scraped_date", "accommodates"]):
        got = silver.silver_listing_for_fact(clean, columns)
        assert sorted(map(repr, got.select(*columns).collect())) == sorted(map(repr, whole.select(*columns).collect())), columns
    feed = silver.property_feed(RentalModel(spark, sources(spark, TIED)).silver_listing, ["listing_id", "property_type"])
    assert sorted(tuple(r) for r in feed.collect()) == [(1, "house"), (2, "house"), (3, "house")]


def test_the_property_mart_moves_narrow_rows_and_each_of_them_once(sort_merge):
    plan = plan_of(queries.queries()["dm_property_type"](sort_merge, SF0001))
    # rows are ranked by no more columns than the mart's facts need
    assert "review_scores_rating" in plan and "review_scores_accuracy" not in plan and "scrape_id" in plan
    # hosts and listings read the same facts and property versions
    assert plan.count("ReusedExchange") == 2
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "ReusedExchange" not in line]
    assert len(moved) == 13


def test_hosts_are_folded_where_the_version_join_left_them(sort_merge):
    for name in ("dm_property_type", "dm_listing_neighbourhood"):
        lines = plan_of(queries.queries()[name](sort_merge, SF0001)).splitlines()
        at = next(n for n, line in enumerate(lines) if "HashAggregate(keys=[host_id" in line and "month_start" in line)
        below = next(line for line in lines[at:] if "Exchange" in line or "SortMergeJoin" in line)
        assert "SortMergeJoin" in below


def test_listings_and_hosts_count_once_in_the_null_month(spark):
    rows = [("1", "7", "2020-05-02", "t", "t", "100.00", "Bondi", {}), ("1", "7", "2021-01-05", "t", "t", "200.00", "Bondi", {}),
            ("1", "7", "2021-02-05", "f", "t", "300.00", "Bondi", {}), ("2", "7", "2021-02-06", "f", "t", None, "Bondi", {}),
            ("3", None, "2021-02-07", "t", None, "50.00", "Bondi", {})]
    m = RentalModel(spark, sources(spark, rows), calendar_bounds=("2020-01-01", "2020-12-31"))
    for mart, listings in ((m.dm_property_type, "active_listings_rate_pct"), (m.dm_listing_neighbourhood, "active_listing_rate_pct")):
        month, none = mart.collect()
        assert (month.month_start, none.month_start) == (dt.date(2020, 5, 1), None)
        assert (month.distinct_hosts, month.superhost_rate_pct, month[listings]) == (1, 100, 100)
        # listings 1, 2, 3, of which 1 and 3 are active somewhere; host 7 only, whose versions are outside the calendar
        assert (none.distinct_hosts, none.superhost_rate_pct, float(none[listings])) == (1, 0, 66.67)
        assert (none.min_price_active, none.max_price_active, none.total_stays_active) == (50, 200, 40)


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.length())) if f.startswith("shuffle_")}


def test_writes_give_their_shuffle_files_back(spark):
    before = shuffle_files(spark)
    staged = queries.stage(spark, spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count())
    assert not shuffle_files(spark) - before
    assert staged.count() == 10 and shuffle_files(spark) - before  # other queries keep theirs as the session says


def test_a_build_gives_its_shuffle_files_back(spark, scratch):
    before = shuffle_files(spark)
    m = build(spark, sources(spark, TIED), f"t_{uuid.uuid4().hex}", scratch, run_id="r", calendar_bounds="data")
    assert not shuffle_files(spark) - before
    assert m.observed["fact_listings"]["rows"] == 3
