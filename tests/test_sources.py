import uuid

from lodgelake.plans.silver import silver_airbnb_clean
from lodgelake.sources.raw import read_source
from lodgelake.sources.scrape_view import raw_sources

SF0001 = "/root/testdata/sf0.001"


def test_csv_source_read_with_explicit_schema(spark, scratch):
    raw = raw_sources(spark, SF0001)["airbnb_raw"]
    (raw.write.option("header", "true").option("ignoreLeadingWhiteSpace", "false")
     .option("ignoreTrailingWhiteSpace", "false").csv(f"{scratch}/airbnb_raw"))
    back = read_source(spark, "airbnb_raw", f"{scratch}/airbnb_raw", fmt="csv")
    assert [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in raw.schema]
    a = sorted(map(repr, (tuple(r) for r in silver_airbnb_clean(raw).collect())))
    b = sorted(map(repr, (tuple(r) for r in silver_airbnb_clean(back).collect())))
    assert a == b and len(a) > 0


def test_month_load_prunes_bronze_partitions(spark, scratch):
    from lodgelake.plans.build import build
    m = build(spark, raw_sources(spark, SF0001), f"t_{uuid.uuid4().hex}", scratch, run_id="r", tables=["airbnb"], calendar_bounds="data")
    month = [r[0] for r in m.airbnb.select("source_month").distinct().orderBy("source_month").collect()][-1]
    one = silver_airbnb_clean(m.airbnb, months=[month.isoformat()])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source_month" in plan and "source_month#" in plan
    assert one.count() == silver_airbnb_clean(m.airbnb).where(f"source_month = date'{month.isoformat()}'").count()
