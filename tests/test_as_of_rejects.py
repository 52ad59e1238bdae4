import datetime as dt
import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lodgelake.operators.as_of import as_of_join
from lodgelake.plans import silver
from lodgelake.sources.schemas import AIRBNB_RAW
from lodgelake.sources.sinks import write_table


def brute(facts, versions):
    out = []
    for key, at, tag in facts:
        hit = [v for v in versions if key is not None and at is not None and v[0] == key and v[1] <= at and (v[2] is None or at < v[2])]
        assert len(hit) <= 1
        out.append((key, at, tag, *(hit[0][1:] if hit else (None, None, None))))
    return sorted(out, key=repr)


def made(rng, hot):
    """Versions of any length with gaps, single days and open ends; facts on and around their bounds."""
    day = dt.date(2020, 1, 1)
    versions, facts = [], []
    for key in range(12):
        at = day + dt.timedelta(days=rng.randint(0, 400))
        for k in range(rng.randint(0, 6)):
            length = rng.choice([1, 1, 20, 31, 90, 700])
            last = rng.random() < 0.2
            versions.append((key, at, None if last else at + dt.timedelta(days=length), f"v{key}.{k}"))
            if last:
                break
            at += dt.timedelta(days=length + rng.choice([0, 0, 5, 200]))
    for tag in range(400):
        key = 3 if hot and tag % 2 else rng.choice([*range(14), None])
        around = [v[1] for v in versions if v[0] == key] + [v[2] for v in versions if v[0] == key and v[2]]
        at = rng.choice(around) + dt.timedelta(days=rng.randint(-1, 1)) if around and rng.random() < 0.6 else day + dt.timedelta(days=rng.randint(-50, 2500))
        facts.append((key, None if rng.random() < 0.03 else at, tag % 100))
    return facts, versions


@pytest.mark.parametrize("seed, salts, unit", [(1, 1, "quarter"), (2, 1, "month"), (3, 4, "year"), (4, 7, "quarter")])
def test_versions_of_any_interval(spark, seed, salts, unit):
    facts, versions = made(random.Random(seed), hot=seed % 2)
    f = spark.createDataFrame(facts, "k bigint, at date, tag int")
    v = spark.createDataFrame(versions, "k bigint, dbt_valid_from date, dbt_valid_to date, name string")
    joined = as_of_join(f, v, "k", "at", ["dbt_valid_from", "dbt_valid_to", "name"], unit=unit, salts=salts)
    assert joined.columns == ["k", "at", "tag", "dbt_valid_from", "dbt_valid_to", "name"]
    assert sorted((tuple(r) for r in joined.collect()), key=repr) == brute(facts, versions)


def test_timestamps_and_no_range_join(spark):
    f = spark.createDataFrame([(1, dt.datetime(2020, 4, 1, 10)), (1, dt.datetime(2020, 4, 1, 9, 59)), (1, dt.datetime(2020, 3, 1))], "k int, at timestamp_ntz")
    v = spark.createDataFrame([(1, dt.datetime(2020, 4, 1, 10), None, "b"), (1, dt.datetime(2020, 3, 31), dt.datetime(2020, 4, 1, 10), "a")],
                              "k int, s timestamp_ntz, e timestamp_ntz, name string")
    joined = as_of_join(f, v, "k", "at", ["name"], start="s", end="e")
    assert sorted((str(r.at), r.name) for r in joined.collect()) == [("2020-03-01 00:00:00", None), ("2020-04-01 09:59:00", "a"), ("2020-04-01 10:00:00", "b")]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert as_of_join(f.where("false"), v, "k", "at", ["name"], start="s", end="e").collect() == []
    assert [r.name for r in as_of_join(f, v.where("false"), "k", "at", ["name"], start="s", end="e").collect()] == [None] * 3


def raw_rows(spark):
    rows = []
    for i, (price, size, day) in enumerate([("10.50", "2", "2020-05-02"), ("about ten", "2", "2020-05-03"), (" ", "two", "2020-05-04"),
                                            ("12", "1", "some day"), ("n/a", "x", "2020-05-06"), ("13", None, "2020-07-01")]):
        r = dict.fromkeys(AIRBNB_RAW.fieldNames())
        r.update(listing_id=str(i), host_id="7", scraped_date=day, price=price, accommodates=size, source_month=dt.date(2020, 5, 1), source_file="f")
        rows.append(r)
    rows.append({**rows[1], "listing_id": " ", "host_id": None})  # no key: dropped, not rejected
    return spark.createDataFrame(rows, AIRBNB_RAW)


def test_a_bad_number_fails_the_strict_load(spark):
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        silver.silver_airbnb_clean(raw_rows(spark)).collect()


def test_bad_rows_are_set_aside_by_one_write(spark, scratch):
    judged = silver.silver_airbnb_judged(raw_rows(spark))
    table, seen = write_table(judged, f"default.t_{uuid.uuid4().hex}", f"{scratch}/judged", ["rejected"], metrics={"bad": F.count_if("rejected")})
    assert seen == {"rows": 5, "bad": 4}
    clean, bad = silver.clean_rows(table), silver.rejected_values(table)
    assert [r.listing_id for r in clean.collect()] == [0]
    assert clean.columns == silver.silver_airbnb_clean(raw_rows(spark)).columns
    assert sorted((r.listing_id, r.column_name, r.raw_text) for r in bad.collect()) == [
        ("1", "price", "about ten"), ("2", "accommodates", "two"), ("3", "scraped_date", "some day"), ("4", "accommodates", "x"), ("4", "price", "n/a")]
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "rejected" in plan


def test_good_rows_are_the_same_in_both_modes(spark):
    good = raw_rows(spark).where("listing_id in ('0', '5')")
    assert silver.clean_rows(silver.silver_airbnb_judged(good)).collect() == silver.silver_airbnb_clean(good).collect()
