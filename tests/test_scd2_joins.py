import datetime as dt

from lodgelake.operators.joins import month_version_join
from lodgelake.operators.scd2 import month_versions, scd2_merge, scd2_replay

d = dt.date
COLS = ["host_id", "name", "scraped_date"]


def feed(spark, rows):
    return spark.createDataFrame(rows, "host_id long, name string, scraped_date date")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLS, "dbt_valid_from", "dbt_valid_to").collect())


def test_replay_equals_in_order_merges(spark):
    may = [(1, "a", d(2020, 5, 2)), (2, "b", d(2020, 5, 3))]
    jun = [(1, "a", d(2020, 6, 2))]                       # same attributes, later date: new version anyway
    jul = [(1, "c", d(2020, 7, 9)), (2, "b", d(2020, 7, 1))]
    full = scd2_replay(feed(spark, may + jun + jul), "host_id", "scraped_date", COLS)
    # each monthly run reads the previous run's written snapshot: checkpoint in between
    snap = scd2_replay(feed(spark, may), "host_id", "scraped_date", COLS).checkpoint()
    snap = scd2_merge(snap, feed(spark, jun), "host_id", "scraped_date", COLS).checkpoint()
    snap = scd2_merge(snap, feed(spark, jul), "host_id", "scraped_date", COLS)
    assert rows_of(full) == rows_of(snap)
    assert rows_of(full)[0] == (1, "a", d(2020, 5, 2), d(2020, 5, 2), d(2020, 6, 2))
    open_versions = [r for r in rows_of(full) if r[-1] is None]
    assert len(open_versions) == 2


def test_merge_is_idempotent_and_drops_late_months(spark):
    jun = [(1, "a", d(2020, 6, 2))]
    snap = scd2_replay(feed(spark, jun), "host_id", "scraped_date", COLS).checkpoint()
    again = scd2_merge(snap, feed(spark, jun), "host_id", "scraped_date", COLS)
    assert rows_of(again) == rows_of(snap)
    late = scd2_merge(snap, feed(spark, [(1, "z", d(2020, 5, 2))]), "host_id", "scraped_date", COLS)
    assert rows_of(late) == rows_of(snap)
    # replay accepts any order: May is kept
    replay = scd2_replay(feed(spark, jun + [(1, "z", d(2020, 5, 2))]), "host_id", "scraped_date", COLS)
    assert len(rows_of(replay)) == 2


def test_month_versions_and_point_in_time_join(spark):
    snap = scd2_replay(feed(spark, [(9, "may", d(2020, 5, 20)), (9, "jul", d(2020, 7, 3))]),
                       "host_id", "scraped_date", COLS)
    versions = month_versions(snap, "host_id", ["name"])
    got = sorted((r.record_start_date, r.record_end_date) for r in versions.collect())
    assert got == [(dt.datetime(2020, 5, 1), dt.datetime(2020, 6, 1)), (dt.datetime(2020, 7, 1), dt.datetime(2020, 8, 1))]
    facts = spark.createDataFrame([(9, d(2020, 5, 1)), (9, d(2020, 5, 31)), (9, d(2020, 6, 1)), (9, d(2020, 7, 15))],
                                  "host_id long, at date")
    joined = month_version_join(facts, versions, "host_id", "at", ["name"])
    assert sorted((r.at, r.name) for r in joined.collect()) == [
        (d(2020, 5, 1), "may"), (d(2020, 5, 31), "may"), (d(2020, 6, 1), None), (d(2020, 7, 15), "jul")]
    assert joined.count() == facts.count()
