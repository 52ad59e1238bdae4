import uuid

import pytest
from pyspark.sql import functions as F

from lodgelake.plans.build import build
from lodgelake.plans.incremental import land_month, read_landed
from lodgelake.plans.model import RentalModel
from lodgelake.plans.refresh import PANELS, refresh_months, store_marts
from lodgelake.sources.scrape_view import raw_sources

SF0001 = "/root/testdata/sf0.001"
MARTS = [mart for _, mart in PANELS.values()]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def sources(spark):
    src = raw_sources(spark, SF0001)
    months = [r[0] for r in src["airbnb_raw"].select("source_month").distinct().orderBy("source_month").collect()]
    return src, months


# a calendar that ends inside the scrapes (facts after it meet in the null month), and one that holds them all
@pytest.mark.parametrize("bounds", [("1992-01-01", "1999-12-31"), ("1996-03-01", "1997-10-15")])
def test_refreshed_marts_equal_a_full_build(spark, scratch, sources, bounds):
    src, months = sources
    raw, database = src["airbnb_raw"], f"t_{uuid.uuid4().hex}"
    bronze = f"{scratch}/landed"
    inside = [m for m in months if bounds[0] <= str(m) <= bounds[1]]
    early, late = inside[2], inside[-1]  # a month that comes late, and the newest one
    half = F.xxhash64("listing_id", "scrape_id", "number_of_reviews") % 2 == 0
    land_month(raw.where(~F.col("source_month").isin(early, late) | (half & (F.col("source_month") == F.lit(early)))), bronze, "first")
    model = build(spark, {**src, "airbnb_raw": read_landed(spark, bronze)}, database, scratch, run_id="r", calendar_bounds=bounds)
    stored = store_marts(model, database, scratch, "r")
    for month, rows in ((late, raw.where(F.col("source_month") == F.lit(late))), (early, raw.where(~half & (F.col("source_month") == F.lit(early))))):
        land_month(rows, bronze, "second")
        landed = {**src, "airbnb_raw": read_landed(spark, bronze).where(F.col("source_month") == F.lit(month))}
        done = refresh_months(stored, landed, bounds)
        again = refresh_months(stored, landed, bounds)  # a refresh may be repeated
        assert done == again and all(month in m for m in done.values())
        assert len(done["dm_property_type"]) < len(inside) / 2
    full = RentalModel(spark, src, calendar_bounds=bounds)
    for mart in MARTS:
        got = spark.table(f"{database}_gold.{mart}")
        assert rows_of(got) == rows_of(getattr(full, mart).select(*got.columns)), mart
    assert rows_of(stored.table("fact_listings").select(*full.fact_listings.columns)) == rows_of(full.fact_listings)


def test_a_panel_of_one_month_lists_its_files_only(spark, scratch, sources):
    src, months = sources
    model = build(spark, src, f"t_{uuid.uuid4().hex}", scratch, run_id="r", calendar_bounds="data")
    one = spark.createDataFrame([(months[5],)], "month date")
    panel = model.property_panel(one)
    want = rows_of(model.property_panel().where(F.col("month_start") == F.lit(months[5])))
    assert rows_of(panel) == want and want
    plan = plan_of(panel)
    scans = [line for line in plan.split("\n") if "FileScan" in line or "Scan parquet" in line]
    big = [s for s in scans if "month" in s]
    assert len(big) >= 3 and all("dynamicpruning" in s for s in big)
    # what the pruned scans read: one partition each
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        flat = model.property_panel(one)
        flat.collect()
        text = flat._jdf.queryExecution().executedPlan()
        read = [int(m.value()) for m in _metrics(text, "numPartitions")]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read and set(read) == {1}


def _metrics(plan, name):
    """Metric ``name`` of every scan of a physical plan."""
    found = []
    todo = [plan]
    while todo:
        node = todo.pop()
        metrics = node.metrics()
        if metrics.contains(name) and node.nodeName().startswith("Scan"):
            found.append(metrics.apply(name))
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return found
