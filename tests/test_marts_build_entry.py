import datetime as dt
import os
import uuid

import duckdb
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lodgelake import queries as registry
from lodgelake.plans import checks
from lodgelake.plans.build import build
from lodgelake.plans.checks import violations
from lodgelake.plans.model import RentalModel
from lodgelake.sources.schemas import AIRBNB_RAW, LGA_CODE, LGA_SUBURB, CENSUS_G01, CENSUS_G02
from lodgelake.sources.sinks import write_table
from lodgelake.sources.scrape_view import raw_sources
from tools.oracle_check import digest

SF0001 = "/root/testdata/sf0.001"


def scrape(spark, rows):
    full = []
    for listing, host, date, flag, superhost in rows:
        r = {f.name: None for f in AIRBNB_RAW.fields}
        day = dt.date.fromisoformat(date)
        r.update(listing_id=str(listing), host_id=str(host), scraped_date=date, has_availability=flag,
                 host_is_superhost=superhost, property_type="House", room_type="Entire", accommodates="2",
                 price="100.00", availability_30="10", listing_neighbourhood="Bondi",
                 host_neighbourhood="Bondi", source_month=day.replace(day=1))
        full.append(r)
    return {
        "airbnb_raw": spark.createDataFrame(full, AIRBNB_RAW),
        "lga_code": spark.createDataFrame([("10050", "Waverley")], LGA_CODE),
        "lga_suburb": spark.createDataFrame([("Waverley", "Bondi")], LGA_SUBURB),
        "census_g01": spark.createDataFrame([], CENSUS_G01),
        "census_g02": spark.createDataFrame([], CENSUS_G02),
    }


def test_pct_change_uses_previous_present_month(spark):
    rows = [(1, 7, "2020-05-02", "t", "t"), (2, 7, "2020-05-03", "t", "t"),
            (1, 7, "2020-07-02", "t", "t"), (2, 7, "2020-07-03", "t", "t"), (3, 8, "2020-07-04", "t", "f")]
    m = RentalModel(spark, scrape(spark, rows), calendar_bounds="data")
    out = {r.month_start: r for r in m.dm_property_type.collect()}
    assert set(out) == {dt.date(2020, 5, 1), dt.date(2020, 7, 1)}
    assert out[dt.date(2020, 5, 1)].pct_change_active_listings_mom is None
    assert out[dt.date(2020, 7, 1)].pct_change_active_listings_mom == 50.0
    assert out[dt.date(2020, 7, 1)].superhost_rate_pct == 50.0
    lga = {(r.month_start, r.host_neighbourhood_lga) for r in m.dm_host_neighbourhood.collect()}
    assert lga == {(dt.date(2020, 5, 1), "waverley"), (dt.date(2020, 7, 1), "waverley")}


def test_literal_superhost_is_all_false(spark):
    rows = [(1, 7, "2020-05-02", "t", "t"), (2, 8, "2020-05-02", "t", "f")]
    literal = RentalModel(spark, scrape(spark, rows), calendar_bounds="data", literal=True)
    assert {r.host_is_superhost for r in literal.silver_host.collect()} == {False}
    intent = RentalModel(spark, scrape(spark, rows), calendar_bounds="data")
    assert {r.host_is_superhost for r in intent.silver_host.collect()} == {True, False}


def test_fact_outside_calendar_gets_null_date(spark):
    rows = [(1, 7, "2020-05-02", "t", "t"), (1, 7, "2031-01-01", "t", "t")]
    m = RentalModel(spark, scrape(spark, rows), calendar_bounds=("2019-01-01", "2030-12-31"))
    assert sorted((r.date_id is None) for r in m.fact_listings.collect()) == [False, True]
    months = [r.month_start for r in m.dm_property_type.collect()]
    assert months == [dt.date(2020, 5, 1), None]  # null month sorts last


def test_build_publishes_and_never_overwrites(spark, scratch):
    tables, database = ["airbnb", "silver_airbnb_clean", "silver_listing_for_fact", "fact_listings"], f"t_{uuid.uuid4().hex}"
    m1 = build(spark, raw_sources(spark, SF0001), database, scratch, run_id="r1", tables=tables, calendar_bounds="data")
    assert set(m1.tables) == set(tables) and all("__r1." in t for t in m1.tables.values())
    m2 = build(spark, raw_sources(spark, SF0001), database, scratch, run_id="r2", tables=tables, calendar_bounds="data")
    assert m1.observed["airbnb"]["rows"] == spark.table(f"{database}_bronze.airbnb").count() == m2.observed["airbnb"]["rows"] > 0
    published = spark.table(f"{database}_gold.fact_listings")
    assert all("/r2/" in f for f in published.inputFiles()) and published.count() == m1.fact_listings.count()
    assert all("/r1/" in f for f in spark.table(m1.tables["fact_listings"]).inputFiles())  # previous run left in place


def test_build_resumes_a_run(spark, scratch):
    tables, database = ["airbnb", "silver_airbnb_clean", "silver_listing_for_fact", "fact_listings"], f"t_{uuid.uuid4().hex}"
    build(spark, raw_sources(spark, SF0001), database, scratch, run_id="r1", tables=tables[:2], calendar_bounds="data")
    os.makedirs(f"{scratch}/r1/silver/silver_listing_for_fact/left_by_a_failed_attempt")
    m = build(spark, raw_sources(spark, SF0001), database, scratch, run_id="r1", tables=tables, calendar_bounds="data")
    assert set(m.observed) == set(tables[2:])  # the others were read, not written
    assert m.fact_listings.count() == m.silver_listing_for_fact.count() > 0


def test_writes_count_what_the_quality_query_counts(spark, scratch):
    """Row counts and violations come from the writes and equal those of the query, which scans the tables."""
    m = build(spark, raw_sources(spark, SF0001), f"t_{uuid.uuid4().hex}", scratch, run_id="r1", calendar_bounds="data", check_calendar=registry.SHORT_CALENDAR)
    want = {r.check_name: r.violations for r in registry.quality_report(spark, SF0001).collect()}
    assert violations(m.observed) == want
    assert all(m.observed[t]["rows"] == spark.table(m.tables[t]).count() for t in ("silver_host", "dim_host", "fact_listings"))


def test_writes_see_duplicates(spark, scratch):
    rows = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (2, 10), (None, 5), (None, 5)], "host_id long, scraped_date int")
    checked_rows = checks.checked("silver_host", rows, None, None)
    table, seen = write_table(checked_rows, f"default.t_{uuid.uuid4().hex}", f"{scratch}/t", metrics=checks.metrics(checked_rows))
    assert seen == {"rows": 6, "silver_host_duplicate_host_date": 2} and table.columns == rows.columns


def test_default_calendar_has_the_published_days(spark):
    m = RentalModel(spark, scrape(spark, [(1, 7, "2020-05-02", "t", "t")]))
    assert m.dim_date.count() == 4383
    assert tuple(m.dim_date.agg(F.min("date_id"), F.max("date_id")).first()) == (20190101, 20301231)


def test_mart_plans_copy_no_rows_per_distinct_count(spark):
    m = RentalModel(spark, raw_sources(spark, SF0001), calendar_bounds="data")
    for mart in (m.dm_property_type, m.dm_listing_neighbourhood, m.dm_host_neighbourhood):
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "Cartesian" not in plan


def test_registered_queries_start_no_job_and_read_pruned_columns(spark):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    df = entry.queries()["dim_suburb"](spark, SF0001)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before <= 7  # schemas of the tables only
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan and "p_size" not in plan


def test_marts_hold_when_a_third_of_the_facts_have_no_host(spark):
    rows = [(i, 7 + i % 5, "2020-05-02", "t", "t") for i in range(40)]
    src = scrape(spark, rows)
    blank = src["airbnb_raw"].withColumn("host_id", F.when(F.col("listing_id").cast("int") % 3 == 0, F.lit(" ")).otherwise(F.col("host_id")))
    m = RentalModel(spark, {**src, "airbnb_raw": blank}, calendar_bounds="data")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        row = m.dm_property_type.collect()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (row.distinct_hosts, row.superhost_rate_pct, row.active_listings_rate_pct) == (5, 100, 100)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "median_price_active" in df.columns


def test_queries_match_oracle_at_sf0001(spark):
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    for name in ["dm_property_type", "dm_listing_neighbourhood", "dm_host_neighbourhood",
                 "dm_host_neighbourhood_literal", "fact_listings", "dim_host", "host_snapshot_merged",
                 "quality_report"]:
        df = qs[name](spark, SF0001)
        res = con.execute(sqls[name])
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(res.fetchall(), dcols)[0], name
