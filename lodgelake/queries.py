"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with their DuckDB oracles.

Every query reads the supplied tables in full (through the scrape view) and runs
the model on them; nothing is sampled or capped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake import oracle_sql as osql
from lodgelake.functions.dates import date_from_id
from lodgelake.operators.as_of import as_of_join
from lodgelake.operators.joins import month_version_join
from lodgelake.operators.lookup import lga_lookup_table, priority_lookup
from lodgelake.plans import silver
from lodgelake.plans.build import build
from lodgelake.plans.checks import violations
from lodgelake.plans.incremental import merge_month_snapshots
from lodgelake.plans.model import TABLES, RentalModel
from lodgelake.session import ensure_checkpoint_dir, shuffles_freed
from lodgelake.sources.raw import read_sources
from lodgelake.sources.scrape_view import raw_sources

Query = Callable[[SparkSession, str], DataFrame]


#: A calendar shorter than the scrapes: facts outside it have no date and meet in the null month.
SHORT_CALENDAR = ("1996-03-01", "1997-10-15")


def stage(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that read it several times."""
    path = f"{ensure_checkpoint_dir(spark)}/staged_{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def model(spark: SparkSession, sf_dir: str, literal: bool = False, month_from: str = "order",
          bounds: tuple[str, str] | str = "data", staged: bool = False) -> RentalModel:
    """The model over the supplied tables, lazily: each query is one plan over pruned scans.  ``staged`` writes the
    cleaned scrape, so that a plan that reads it several times joins the supplied tables once.  Production runs
    write every table once (``plans.build``)."""
    once = (lambda name, df: stage(spark, df) if name == "silver_airbnb_clean" else df) if staged else None
    return RentalModel(spark, raw_sources(spark, sf_dir, month_from=month_from), calendar_bounds=bounds, literal=literal, materialize=once,
                       stored=["silver_airbnb_clean"] if staged else None)


def _rel(name: str, **kw) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(model(spark, sf_dir, **kw), name)
    run.__name__ = name
    return run


def _merged_snapshot(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The monthly load as it runs in production: all months but the last two are loaded at once,
    then one month after another is merged into the published snapshots, each run written to bucketed tables, published
    and read back.  The last load is executed twice.  Equals the replay of all months."""
    sources = raw_sources(spark, sf_dir)
    raw = stage(spark, sources["airbnb_raw"])  # as it landed: every load reads its months of it
    sources = {**sources, "airbnb_raw": raw}
    database = f"snapshots_{uuid.uuid4().hex}"
    last = raw.agg(F.max("source_month")).first()[0]  # one scalar: the newest load month
    if last is None:
        return getattr(RentalModel(spark, sources), name)
    newest, before = F.lit(last), F.add_months(F.lit(last), -1)
    month = F.col("source_month")
    for run_id, rows in (("history", month < before), ("before", month == before), ("newest", month == newest), ("newest", month == newest)):
        merge_month_snapshots(spark, database, ensure_checkpoint_dir(spark), {**sources, "airbnb_raw": raw.where(rows)}, run_id=run_id)
    return spark.table(f"{database}.{name}")


def host_snapshot_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_snapshot(spark, sf_dir, "host_snapshot")


def property_snapshot_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_snapshot(spark, sf_dir, "property_snapshot")


def fact_host_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point-in-time join: each fact with the host version valid on its date."""
    m = model(spark, sf_dir, staged=True)
    # the calendar lookup is the arithmetic inverse of date_id
    facts = m.fact_listings.select("listing_id", "host_id", "date_id").withColumn(
        "scraped_date", date_from_id("date_id"))
    return month_version_join(facts, m.dim_host, "host_id", "scraped_date",
                              ["host_name", "host_is_superhost", "host_neighbourhood", "host_since"])


def fact_host_version_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each fact with the host version of the snapshot itself that holds on its date, whatever the version's length."""
    m = model(spark, sf_dir, staged=True)
    facts = m.fact_listings.select("listing_id", "host_id", "date_id").withColumn("scraped_date", date_from_id("date_id"))
    # a day after the scrape, so that versions of other months are asked for as well
    facts = facts.withColumn("asked_date", F.date_add("scraped_date", 45))
    return as_of_join(facts, m.host_snapshot, "host_id", "asked_date", ["dbt_valid_from", "dbt_valid_to", "host_name", "host_neighbourhood"])


def _with_bad_numbers(airbnb: DataFrame) -> DataFrame:
    """The scrape with some numbers that do not parse."""
    fourth = F.col("number_of_reviews") == "4"
    return (airbnb.withColumn("price", F.when(fourth & (F.col("room_type") == "R"), F.concat(F.lit("about "), "price")).otherwise(F.col("price")))
            .withColumn("accommodates", F.when(fourth & (F.col("accommodates") == "3"), F.lit("three")).otherwise(F.col("accommodates")))
            .withColumn("scraped_date", F.when(fourth & (F.col("accommodates") == "2"), F.lit("some day")).otherwise(F.col("scraped_date"))))


def silver_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the scrape that do not parse, set aside with the keys of their rows."""
    return silver.rejected_values(silver.silver_airbnb_judged(_with_bad_numbers(model(spark, sf_dir).airbnb)))


def silver_airbnb_clean_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean rows of a scrape whose bad rows are set aside."""
    return silver.clean_rows(silver.silver_airbnb_judged(_with_bad_numbers(model(spark, sf_dir).airbnb)))


def _built(spark: SparkSession, sf_dir: str, tables: list[str]) -> tuple[RentalModel, str]:
    """The whole way of a load: sources as CSV text, read with their schemas, built table by table, published by layer."""
    database = f"rental_{uuid.uuid4().hex}"
    root = f"{ensure_checkpoint_dir(spark)}/{database}"
    with shuffles_freed(spark):
        for name, df in raw_sources(spark, sf_dir).items():
            (df.write.option("header", "true").option("compression", "gzip").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
             .csv(f"{root}/raw/{name}"))
    return build(spark, read_sources(spark, f"{root}/raw", "csv"), database, f"{root}/tables", tables=tables,
                 check_calendar=SHORT_CALENDAR, calendar_bounds="data"), database


def built_fact_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact table of the gold layer after a load from CSV."""
    m, database = _built(spark, sf_dir, ["airbnb", "silver_airbnb_clean", "silver_listing_for_fact", "fact_listings"])
    return spark.table(f"{database}_gold.fact_listings").select(*m.fact_listings.columns)


def built_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report as the writes of a full load counted it: no table is scanned again."""
    m, _ = _built(spark, sf_dir, TABLES)
    return spark.createDataFrame(sorted(violations(m.observed).items()), "check_name string, violations bigint")


def lga_priority_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every host version with its LGA (suburb > LGA name > override), multiplicities kept."""
    m = model(spark, sf_dir)
    hosts = m.dim_host.select("host_id", "record_start_date", "host_neighbourhood",
                              F.lower(F.trim("host_neighbourhood")).alias("neighbourhood"))
    table = lga_lookup_table(m.ref_lga, m.lga_overrides)
    return priority_lookup(hosts, "neighbourhood", table).drop("neighbourhood")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality checks (§5.2): one row per check with its violation count."""
    m = model(spark, sf_dir, staged=True)

    def dup(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.groupBy(*keys).count().where(F.col("count") > 1).agg(F.count(F.lit(1)).alias("n"))

    def check(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("check_name"), F.col("n").cast("bigint").alias("violations"))

    def unmatched(keys: DataFrame, dim: DataFrame, key: str) -> DataFrame:
        return keys.where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n"))

    dates = m.dim_date.where(F.col("scraped_date").between(*[F.lit(d).cast("date") for d in SHORT_CALENDAR]))
    lost = (m.airbnb.select(F.lit(1).alias("w")).unionByName(m.silver_airbnb_clean.select(F.lit(-1).alias("w")))
            .agg(F.coalesce(F.sum("w"), F.lit(0)).alias("n")))
    checks = [
        check("silver_host_duplicate_host_date", dup(m.silver_host, ["host_id", "scraped_date"])),
        check("listing_for_fact_duplicate_listing_month",
              dup(m.silver_listing_for_fact, ["listing_id", "month_start"])),
        check("dim_host_duplicate_host_month", dup(m.dim_host, ["host_id", "record_start_date"])),
        check("dim_property_duplicate_listing_month", dup(m.dim_property, ["listing_id", "record_start_date"])),
        check("host_snapshot_open_versions_over_one",
              dup(m.host_snapshot.where(F.col("dbt_valid_to").isNull()), ["host_id"])),
        check("dim_date_duplicate_date", dup(m.dim_date, ["date_id"])),
        check("dim_suburb_duplicate_suburb", dup(m.dim_suburb, ["suburb_id"])),
        check("fact_dates_outside_short_calendar", unmatched(m.fact_listings.select("date_id"), dates, "date_id")),
        check("fact_suburbs_not_in_dim_suburb", unmatched(m.fact_listings.select("suburb_id"), m.dim_suburb, "suburb_id")),
        check("scrape_rows_dropped_by_cleaning", lost),
    ]
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


QUALITY_SQL_BODY = """
SELECT 'silver_host_duplicate_host_date' AS check_name,
       (SELECT count(*) FROM (SELECT host_id, scraped_date FROM silver_host GROUP BY ALL HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'listing_for_fact_duplicate_listing_month',
       (SELECT count(*) FROM (SELECT listing_id, month_start FROM silver_listing_for_fact GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'dim_host_duplicate_host_month',
       (SELECT count(*) FROM (SELECT host_id, record_start_date FROM dim_host GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'dim_property_duplicate_listing_month',
       (SELECT count(*) FROM (SELECT listing_id, record_start_date FROM dim_property GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'host_snapshot_open_versions_over_one',
       (SELECT count(*) FROM (SELECT host_id FROM host_snapshot WHERE dbt_valid_to IS NULL GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'dim_date_duplicate_date',
       (SELECT count(*) FROM (SELECT date_id FROM dim_date GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'dim_suburb_duplicate_suburb',
       (SELECT count(*) FROM (SELECT suburb_id FROM dim_suburb GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'fact_dates_outside_short_calendar',
       (SELECT count(*) FROM fact_listings JOIN dim_date USING (date_id)
        WHERE NOT scraped_date BETWEEN DATE '{first}' AND DATE '{last}')
UNION ALL SELECT 'fact_suburbs_not_in_dim_suburb',
       (SELECT count(*) FROM fact_listings WHERE suburb_id NOT IN (SELECT suburb_id FROM dim_suburb))
UNION ALL SELECT 'scrape_rows_dropped_by_cleaning',
       (SELECT count(*) FROM src_airbnb) - (SELECT count(*) FROM silver_airbnb_clean)
""".format(first=SHORT_CALENDAR[0], last=SHORT_CALENDAR[1])

LGA_LOOKUP_SQL_BODY = f"""
, {osql.lga_of_neighbourhood()}
SELECT host_id, record_start_date, host_neighbourhood,
       CAST(placed.lga_code AS VARCHAR) AS host_neighbourhood_lga_code, placed.lga_name AS host_neighbourhood_lga
FROM dim_host LEFT JOIN placed ON placed.place = lower(trim(host_neighbourhood))
"""

FACT_HOST_VERSION_SQL_BODY = """
SELECT listing_id, facts.host_id, facts.date_id, cal.scraped_date, CAST(cal.scraped_date + 45 AS DATE) AS asked_date,
       version.dbt_valid_from, version.dbt_valid_to, version.host_name, version.host_neighbourhood
FROM fact_listings facts LEFT JOIN dim_date cal USING (date_id)
LEFT JOIN host_snapshot version ON version.host_id = facts.host_id
  AND cal.scraped_date + 45 >= version.dbt_valid_from AND (version.dbt_valid_to IS NULL OR cal.scraped_date + 45 < version.dbt_valid_to)
"""

REJECTS_SQL_BODY = """
, bad AS (
  SELECT listing_id, host_id, scrape_id, source_file, source_month, price, accommodates,
         number_of_reviews = '4' AND room_type = 'R' AND trim(price) <> '' AS bad_price,
         number_of_reviews = '4' AND accommodates = '3' AS bad_size,
         number_of_reviews = '4' AND accommodates = '2' AS bad_date,
         CASE WHEN number_of_reviews = '4' AND accommodates = '2' THEN 'some day' ELSE scraped_date END AS scraped_date
  FROM src_airbnb WHERE trim(listing_id) <> '' OR trim(host_id) <> ''
)
SELECT listing_id, host_id, scrape_id, scraped_date, source_file, source_month, 'price' AS column_name, 'about ' || price AS raw_text FROM bad WHERE bad_price
UNION ALL SELECT listing_id, host_id, scrape_id, scraped_date, source_file, source_month, 'accommodates', 'three' FROM bad WHERE bad_size
UNION ALL SELECT listing_id, host_id, scrape_id, scraped_date, source_file, source_month, 'scraped_date', scraped_date FROM bad WHERE bad_date
"""

LENIENT_SQL_BODY = """
SELECT * FROM silver_airbnb_clean
WHERE NOT (number_of_reviews = 4 AND ((room_type = 'r' AND price IS NOT NULL) OR accommodates IN (2, 3)))
"""

FACT_HOST_AS_OF_SQL_BODY = """
SELECT listing_id, facts.host_id, facts.date_id, cal.scraped_date, version.host_name, version.host_is_superhost,
       version.host_neighbourhood, version.host_since
FROM fact_listings facts LEFT JOIN dim_date cal USING (date_id)
LEFT JOIN dim_host version ON version.host_id = facts.host_id
  AND cal.scraped_date >= version.record_start_date AND cal.scraped_date < version.record_end_date
"""


def _body(sql_body: str) -> str:
    return osql._with(osql.scrape_ctes() + osql.model_ctes(), sql_body)


RELATIONS = [
    "silver_airbnb_clean", "silver_host", "silver_listing", "silver_listing_for_fact",
    "silver_host_for_snapshot", "silver_property_for_snapshot",
    "silver_lga_code_clean", "silver_lga_suburb_clean", "silver_lga",
    "silver_census_g01_clean", "silver_census_g02_clean",
    "host_snapshot", "property_snapshot",
    "dim_date", "dim_host", "dim_property", "dim_suburb", "fact_listings", "ref_lga",
]


# bronze copies of the lookup and census sources (R2-R5) and the published census tables
BRONZE_LOOKUPS = ["lga_code", "lga_suburb", "census_g01", "census_g02"]
REF_CENSUS = {"ref_census_g01": "silver_census_g01_clean", "ref_census_g02": "silver_census_g02_clean"}


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "dm_property_type": _rel("dm_property_type", staged=True),
        "dm_listing_neighbourhood": _rel("dm_listing_neighbourhood", staged=True),
        "dm_host_neighbourhood": _rel("dm_host_neighbourhood", staged=True),
        "dm_host_neighbourhood_literal": _rel("dm_host_neighbourhood", literal=True, staged=True),
    }
    q.update({name: _rel(name) for name in RELATIONS})
    q["dm_listing_neighbourhood_literal"] = _rel("dm_listing_neighbourhood", literal=True, staged=True)
    q["dm_property_type_literal"] = _rel("dm_property_type", literal=True, staged=True)
    q["fact_listings_short_calendar"] = _rel("fact_listings", bounds=SHORT_CALENDAR)
    q["dm_property_type_short_calendar"] = _rel("dm_property_type", bounds=SHORT_CALENDAR, staged=True)
    q["dm_listing_neighbourhood_short_calendar"] = _rel("dm_listing_neighbourhood", bounds=SHORT_CALENDAR, staged=True)
    q["month_guard"] = _rel("silver_airbnb_clean", month_from="ship")
    q["silver_host_literal"] = _rel("silver_host", literal=True)
    q["host_snapshot_merged"] = host_snapshot_merged
    q["property_snapshot_merged"] = property_snapshot_merged
    q["fact_host_as_of"] = fact_host_as_of
    q["fact_host_version_as_of"] = fact_host_version_as_of
    q["silver_rejects"] = silver_rejects
    q["silver_airbnb_clean_lenient"] = silver_airbnb_clean_lenient
    q["built_fact_listings"] = built_fact_listings
    q["built_quality_report"] = built_quality_report
    q["quality_report"] = quality_report
    q["lga_priority_lookup"] = lga_priority_lookup
    q["airbnb"] = _rel("airbnb")
    for name in BRONZE_LOOKUPS + list(REF_CENSUS):
        q[name] = _rel(name)
    return q


def oracle_sql() -> dict[str, str]:
    o = {
        "dm_property_type": osql.mart_property_type(),
        "dm_listing_neighbourhood": osql.mart_listing_neighbourhood(),
        "dm_host_neighbourhood": osql.mart_host_neighbourhood(),
        "dm_host_neighbourhood_literal": osql.mart_host_neighbourhood(literal=True),
    }
    o.update({name: osql.relation(name) for name in RELATIONS})
    o["dm_listing_neighbourhood_literal"] = osql.mart_listing_neighbourhood(literal=True)
    o["dm_property_type_literal"] = osql.mart_property_type(literal=True)
    o["fact_listings_short_calendar"] = osql.relation("fact_listings", bounds=SHORT_CALENDAR)
    o["dm_property_type_short_calendar"] = osql.mart_property_type(bounds=SHORT_CALENDAR)
    o["dm_listing_neighbourhood_short_calendar"] = osql.mart_listing_neighbourhood(bounds=SHORT_CALENDAR)
    o["month_guard"] = osql.relation("silver_airbnb_clean", month_from="ship")
    o["silver_host_literal"] = osql.relation("silver_host", literal=True)
    o["host_snapshot_merged"] = osql.relation("host_snapshot")
    o["property_snapshot_merged"] = osql.relation("property_snapshot")
    o["fact_host_as_of"] = _body(FACT_HOST_AS_OF_SQL_BODY)
    o["fact_host_version_as_of"] = _body(FACT_HOST_VERSION_SQL_BODY)
    o["silver_rejects"] = osql._with_tail(REJECTS_SQL_BODY)
    o["silver_airbnb_clean_lenient"] = _body(LENIENT_SQL_BODY)
    o["built_fact_listings"] = osql.relation("fact_listings")
    o["built_quality_report"] = _body(QUALITY_SQL_BODY)
    o["quality_report"] = _body(QUALITY_SQL_BODY)
    o["lga_priority_lookup"] = osql._with_tail(LGA_LOOKUP_SQL_BODY)
    o["airbnb"] = osql.relation("src_airbnb")
    for name in BRONZE_LOOKUPS:
        o[name] = osql.relation(f"src_{name}")
    for name, silver_name in REF_CENSUS.items():
        o[name] = osql.relation(silver_name)
    return o
