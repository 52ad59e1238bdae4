import os
import uuid

import pytest
from pyspark.sql import functions as F

from lodgelake.operators.scd2 import scd2_advance
from lodgelake.plans import incremental
from lodgelake.plans.build import build
from lodgelake.plans.incremental import land_month, merge_month_snapshots, open_versions, publish, published_runs, read_landed, staged_feed
from lodgelake.plans.model import RentalModel
from lodgelake.plans.silver import HOST_FEED_COLUMNS
from lodgelake.sources.scrape_view import raw_sources
from lodgelake.sources.sinks import write_table

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture()
def database():
    return f"t_{uuid.uuid4().hex}"


def snapshot_rows(df):
    rows = df.select(*HOST_FEED_COLUMNS, "dbt_valid_from", "dbt_valid_to").collect()
    return sorted((tuple(r) for r in rows), key=repr)


def replayed(spark, src):
    return snapshot_rows(RentalModel(spark, src, calendar_bounds="data").host_snapshot)


def runs(spark, database):
    return [run for run, _ in published_runs(spark, database)]


def merged(spark, database):
    return snapshot_rows(spark.table(f"{database}.host_snapshot"))


def test_monthly_merges_equal_replay(spark, scratch, database):
    src = raw_sources(spark, SF0001)
    raw = src["airbnb_raw"]
    months = [r[0] for r in raw.select("source_month").distinct().orderBy("source_month").collect()][-3:]
    merge_month_snapshots(spark, database, scratch, {**src, "airbnb_raw": raw.where(F.col("source_month") < F.lit(months[0]))}, run_id="m0")
    for i, m in enumerate(months):
        merge_month_snapshots(spark, database, scratch, {**src, "airbnb_raw": raw.where(F.col("source_month") == F.lit(m))}, run_id=f"m{i + 1}")
    assert merged(spark, database) == replayed(spark, src)
    # re-merging the last month changes nothing
    merge_month_snapshots(spark, database, scratch, {**src, "airbnb_raw": raw.where(F.col("source_month") == F.lit(months[-1]))}, run_id="again")
    assert merged(spark, database) == replayed(spark, src)


def loads(spark):
    src = raw_sources(spark, SF0001)
    raw = src["airbnb_raw"]
    newest = raw.agg(F.max("source_month")).first()[0]
    of = lambda cond: {**src, "airbnb_raw": raw.where(cond)}
    return src, of(F.col("source_month") < F.lit(newest)), of(F.col("source_month") == F.lit(newest))


def files_of(scratch, what):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(scratch) for f in names if what in d and f.endswith(".parquet")}


def test_same_run_twice_leaves_history(spark, scratch, database):
    src, older, newest = loads(spark)
    merge_month_snapshots(spark, database, scratch, older, run_id="a")
    first = merge_month_snapshots(spark, database, scratch, newest, run_id="b")
    files = files_of(scratch, "versions")
    assert merge_month_snapshots(spark, database, scratch, newest, run_id="b") == first == ["a", "b"]
    assert files_of(scratch, "versions") == files and merged(spark, database) == replayed(spark, src)


def test_closed_history_is_not_written_again(spark, scratch, database):
    src, older, newest = loads(spark)
    merge_month_snapshots(spark, database, scratch, older, run_id="a")
    before = files_of(scratch, "attempt=a_")
    merge_month_snapshots(spark, database, scratch, newest, run_id="b")
    assert before and files_of(scratch, "attempt=a_") == before
    assert any("is_open=false" in f for f in files_of(scratch, "attempt=b_"))


def test_a_merge_shuffles_the_feed_only(spark, scratch, database):
    """Open versions and staged feed lie in the same buckets, so the plan that joins them has no exchange."""
    src, older, newest = loads(spark)
    merge_month_snapshots(spark, database, scratch, older, run_id="a", buckets=5)
    merge_month_snapshots(spark, database, scratch, newest, run_id="b")
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for partitions in ("4", "64"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            a, b = (attempt for _, attempt in published_runs(spark, database))
            rows = scd2_advance(open_versions(spark, database, "host_snapshot", a), staged_feed(spark, database, "host_snapshot", b),
                                "host_id", "scraped_date", HOST_FEED_COLUMNS)
            assert rows.count()
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan and "PartitionFilters" in rows._jdf.queryExecution().explainString(rows.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    buckets = {f.split("_")[-1].split(".")[0] for f in files_of(scratch, "host_snapshot_versions")}
    assert buckets <= {f"{i:05d}" for i in range(5)}


def test_merge_starts_from_a_built_snapshot(spark, scratch, database):
    src, older, newest = loads(spark)
    m = build(spark, older, database, scratch, run_id="full", tables=["host_snapshot", "property_snapshot"], calendar_bounds="data")
    merge_month_snapshots(spark, database, scratch, newest, run_id="b", start={"host_snapshot": m.host_snapshot, "property_snapshot": m.property_snapshot})
    assert merged(spark, database) == replayed(spark, src)


def test_failure_between_write_and_publish_then_retry(spark, scratch, database, monkeypatch):
    src, older, newest = loads(spark)
    merge_month_snapshots(spark, database, scratch, older, run_id="a")
    before = merged(spark, database)

    def fail(*args, **kw):
        raise RuntimeError("lost before publishing")

    monkeypatch.setattr(incremental, "publish", fail)
    with pytest.raises(RuntimeError, match="lost before"):
        merge_month_snapshots(spark, database, scratch, newest, run_id="b")
    assert runs(spark, database) == ["a"] and merged(spark, database) == before
    monkeypatch.undo()
    merge_month_snapshots(spark, database, scratch, newest, run_id="c")
    assert runs(spark, database) == ["a", "c"] and merged(spark, database) == replayed(spark, src)


def test_first_run_may_fail_too(spark, scratch, database, monkeypatch):
    src, older, _ = loads(spark)
    monkeypatch.setattr(incremental, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        merge_month_snapshots(spark, database, scratch, older, run_id="a")
    assert published_runs(spark, database) == [] and merged(spark, database) == []
    monkeypatch.undo()
    merge_month_snapshots(spark, database, scratch, older, run_id="a")
    assert merged(spark, database) == replayed(spark, older)


def test_stale_publisher_is_told_and_names_are_checked(spark, scratch, database):
    src, older, newest = loads(spark)
    merge_month_snapshots(spark, database, scratch, older, run_id="a")
    first = published_runs(spark, database)
    publish(spark, database, [*first, ("b", "b_1")], after=first)
    with pytest.raises(RuntimeError, match="published after"):
        publish(spark, database, [*first, ("late", "late_1")], after=first)
    assert runs(spark, database) == ["a", "b"]
    with pytest.raises(ValueError):
        merge_month_snapshots(spark, database, scratch, newest, run_id="x'); --")


def test_one_month_in_two_drops_keeps_every_row(spark, scratch):
    raw = raw_sources(spark, SF0001)["airbnb_raw"]
    months = [r[0] for r in raw.select("source_month").distinct().orderBy("source_month").collect()][:2]
    bronze = f"{scratch}/bronze/airbnb"
    first = raw.where(F.col("source_month") == F.lit(months[0]))
    half = F.xxhash64("listing_id", "scrape_id", "number_of_reviews") % 2 == 0
    land_month(first.where(half), bronze, "drop1")
    land_month(first.where(~half), bronze, "drop2")
    land_month(raw.where(F.col("source_month") == F.lit(months[1])), bronze, "drop1")
    land_month(first.where(~half), bronze, "drop2")  # once more
    landed = read_landed(spark, bronze)
    want = raw.where(F.col("source_month").isin(months))
    assert landed.columns == raw.columns
    assert sorted(map(repr, landed.collect())) == sorted(map(repr, want.collect()))


def test_a_month_has_files_by_size_not_by_tasks(spark, scratch, database):
    raw = raw_sources(spark, SF0001)["airbnb_raw"].repartition(8)
    write_table(raw, f"default.{database}", f"{scratch}/t", ["source_month"])
    files = [f for d, _, names in os.walk(f"{scratch}/t") for f in names if f.endswith(".parquet")]
    months = raw.select("source_month").distinct().count()
    assert len(files) <= 2 * months
