import pytest
from pyspark.sql import functions as F

from lodgelake.functions.cleaning import (
    cast_blank, census_code, flag_to_bool, lower_trim_after_nullif, normalise)
from lodgelake.plans.silver import silver_airbnb_clean, silver_census_g01_clean, silver_census_g02_clean
from lodgelake.sources.schemas import AIRBNB_RAW, CENSUS_G01, CENSUS_G02


def one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_blank_to_null_then_cast(spark):
    assert one(spark, ["  ", "", None, " 42 "], lambda c: cast_blank(c, "bigint")) == [None, None, None, 42]


def test_bad_text_cast_raises(spark):
    with pytest.raises(Exception):
        one(spark, ["3.0"], lambda c: c.cast("int"))


def test_flag_to_bool(spark):
    assert one(spark, ["T", "f", "x", None], flag_to_bool) == [True, False, None, None]


def test_normalise_with_default(spark):
    assert one(spark, [" Bondi ", "", None, "  "], normalise) == ["bondi", "unknown", "unknown", "unknown"]


def test_trim_after_nullif_keeps_whitespace_only(spark):
    assert one(spark, ["  ", "", " A "], lower_trim_after_nullif) == ["", None, "a"]


def test_census_code_pad_and_cut(spark):
    assert one(spark, ["LGA10050", "50", "1234567", ""], census_code) == ["10050", "00050", "12345", "00000"]


def raw_row(**kw):
    row = {f.name: None for f in AIRBNB_RAW.fields}
    row.update(kw)
    return row


def test_keyless_and_month_guard(spark):
    import datetime as dt
    may, jun = dt.date(2020, 5, 1), dt.date(2020, 6, 1)
    rows = [
        raw_row(listing_id=" ", host_id="7", scraped_date="2020-05-02", source_month=may),   # kept (host key)
        raw_row(listing_id=" ", host_id="", scraped_date="2020-05-02", source_month=may),    # dropped (no key)
        raw_row(listing_id="1", host_id="7", scraped_date="2020-05-31", source_month=jun),   # dropped (month)
        raw_row(listing_id="2", host_id="7", scraped_date=None, source_month=may),           # dropped (null date)
        raw_row(listing_id="3", host_id=None, scraped_date="2020-05-20", source_month=may),  # kept
    ]
    df = spark.createDataFrame(rows, AIRBNB_RAW)
    out = silver_airbnb_clean(df).select("listing_id", "host_id", "host_neighbourhood").collect()
    assert sorted((r.listing_id or 0, r.host_id or 0) for r in out) == [(0, 7), (3, 0)]
    assert {r.host_neighbourhood for r in out} == {"unknown"}


def test_census_blank_codes(spark):
    g01 = spark.createDataFrame([("",) + ("1",) * 14], CENSUS_G01)
    assert [r.lga_code for r in silver_census_g01_clean(g01).collect()] == ["00000"]
    g02 = spark.createDataFrame([("  ", "1", "1", "1", "1", "1")], CENSUS_G02)
    assert silver_census_g02_clean(g02).count() == 0


def test_host_same_date_rows_collapse(spark):
    import datetime as dt
    from lodgelake.plans.silver import silver_host
    may = dt.date(2020, 5, 1)
    rows = [raw_row(listing_id="9", host_id="1", scraped_date="2020-05-02", source_month=may,
                    host_is_superhost="t", host_name="alice"),
            raw_row(listing_id="9", host_id="1", scraped_date="2020-05-02", source_month=may,
                    host_is_superhost="f", host_name="Bob")]
    clean = silver_airbnb_clean(spark.createDataFrame(rows, AIRBNB_RAW))
    out = silver_host(clean).collect()
    assert len(out) == 1 and out[0].host_is_superhost is True and out[0].host_name == "alice"
    assert silver_host(clean, literal=True).first().host_is_superhost is False
