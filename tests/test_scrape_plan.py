"""The plans over the scrape: generated code that the JVM compiles, and how often the large tables move."""
import contextlib
import io
import re

import pytest

from lodgelake import queries

SF0001 = "/root/testdata/sf0.001"
#: The JVM leaves methods of more bytecode than this to its interpreter.
COMPILED_UP_TO = 8000


def explained(df, mode):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode=mode)
    return text.getvalue()


@pytest.fixture()
def sort_merge(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "10k"}
    saved = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["silver_airbnb_clean", "silver_airbnb_clean_lenient", "month_guard"])
def test_cleaning_is_compiled(sort_merge, name):
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(queries.queries()[name](sort_merge, SF0001), "codegen"))]
    assert sizes and max(sizes) < COMPILED_UP_TO


def test_customers_meet_orders_before_line_items(sort_merge):
    sort_merge.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = explained(queries.queries()["airbnb"](sort_merge, SF0001), "simple")
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line]
    assert moved
    below = plan[plan.index(moved[0]):]
    assert "l_extendedprice" not in below.split("Exchange hashpartitioning(c_custkey")[0]


def scans(plan, table):
    return plan.count(f"{SF0001}/{table}.parquet")


@pytest.mark.parametrize("name", ["dm_property_type", "dm_listing_neighbourhood", "dm_host_neighbourhood", "fact_host_as_of",
                                  "fact_host_version_as_of"])
def test_supplied_tables_are_joined_once(sort_merge, name):
    plan = explained(queries.queries()[name](sort_merge, SF0001), "formatted")
    assert "staged_" in plan and scans(plan, "lineitem") == 0


def test_facts_stay_where_they_are_for_the_property_join(sort_merge):
    sort_merge.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = explained(queries.queries()["dm_property_type"](sort_merge, SF0001), "simple")
    by_listing = [line for line in plan.splitlines() if "SortMergeJoin [" in line and "_pit_key" in line]
    assert by_listing and sum("Exchange hashpartitioning(_pit_by" in line for line in plan.splitlines()) == 1  # facts meet hosts
