"""The five raw sources derived from the supplied TPC-H-style tables.

No rental data is supplied, so the raw monthly scrape is a view over
``lineitem ⋈ orders ⋈ part ⋈ customer ⋈ supplier`` (plus nation/region), one scrape
row per line item, every value rendered as raw text the way a CSV scrape arrives.
The LGA lookups come from region/nation and the census tables are per-region
aggregates of ``customer``.  The scrape and the census inputs grow with the data; the
two LGA lookups have as many rows as region and nation at any scale.

Scale notes: line items meet parts and suppliers while they are still narrow, and
customers meet orders, of which there are fewer than line items; ``lineitem ⋈ orders``
on the order key comes last, so line items move at most once per large table and never
with a customer's texts.  Tables are joined one after another, never to a joined pair,
so the planner knows their real sizes (broadcast when small, sort-merge beyond).  Texts
are rendered after the joins by short expressions: with the cleaning behind them
they have to stay below the size up to which the JVM compiles a method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.sources.schemas import (
    AIRBNB_RAW,
    CENSUS_G01_AGE_BANDS,
    CENSUS_G01_COUNTS,
    CENSUS_G02,
    LGA_CODE,
    LGA_SUBURB,
)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Fixed mapping of TPC-H values onto scrape values.
SUPERHOST_BY_STATUS = {"F": "t", "O": "f"}      # anything else ('P') -> unparseable flag
LINESTATUS_FLAG = {"O": "t", "F": "F"}          # upper-case 'F' exercises lower()
HOST_SINCE_ORIGIN = "2008-01-01"
ACCTBAL_BANDS = [-1000, 0, 1000, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 9000, 10001]


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def cents_text(cents: Column) -> Column:
    """Render a non-negative integer number of cents as 'units.cc' text."""
    c = cents.cast("bigint")
    units = F.call_function("div", c, F.lit(100))
    return F.concat(units.cast("string"), F.lit("."), F.lpad((c % 100).cast("string"), 2, "0"))


def day_text(day: Column) -> Column:
    """A date as ``yyyy-MM-dd``."""
    return day.cast("string")


def as_cents(x: Column) -> Column:
    return F.round(x * 100).cast("bigint")


def _hosted_orders(t: dict[str, DataFrame]) -> DataFrame:
    """Orders with what a scrape shows of their customer, the host."""
    nation = t["nation"].select(F.col("n_nationkey").alias("c_nation_of"), F.col("n_name").alias("c_nation"), "n_regionkey")
    region = t["region"].select("r_regionkey", F.col("r_name").alias("c_region"))
    seg = F.col("c_mktsegment")
    host_neighbourhood = (F.when(seg == "BUILDING", F.col("c_nation"))
                           .when(seg == "AUTOMOBILE", F.col("c_region"))
                           .when(seg == "MACHINERY", F.lit("Overseas"))
                           .when(seg == "HOUSEHOLD", F.lit(" "))
                           .otherwise(seg))
    return (t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
            .join(t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("c_nation_of"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), "c_name",
                    host_neighbourhood.alias("host_neighbourhood")))


def airbnb_raw(t: dict[str, DataFrame], month_from: str = "order") -> DataFrame:
    """The raw monthly scrape (all text except ``source_month``).

    ``month_from='ship'`` takes the load month from ``l_shipdate`` so that most rows
    fail the scrape-month guard (F2).
    """
    # whole numbers are taken out of the doubles here: they move in fewer bytes
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                              F.col("l_quantity").cast("int").alias("l_quantity"),
                              as_cents(F.col("l_extendedprice")).alias("l_price_cents"),
                              as_cents(F.col("l_discount") * 100).alias("l_discount_cents"),
                              as_cents(F.col("l_tax") * 100).alias("l_tax_cents"),
                              "l_returnflag", "l_linestatus", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    pt = t["part"].select("p_partkey", "p_type", "p_size")
    su = t["supplier"].select("s_suppkey", "s_nationkey")
    nation = t["nation"].select("n_nationkey", F.col("n_name").alias("s_nation"))
    # Hash-partition the line items by order key: the distribution the sort-merge
    # join with orders needs anyway at scale (no extra exchange), and parallelism
    # when the input is a few large files and orders is small enough to broadcast.
    rows = (li.join(pt, F.col("l_partkey") == F.col("p_partkey"))
              .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
              .repartition("l_orderkey")
              .join(_hosted_orders(t), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(nation, F.col("s_nationkey") == F.col("n_nationkey")))

    last_line = F.col("l_linenumber") == 7
    listing_blank = last_line & (F.col("l_returnflag") == "R")
    host_blank = last_line & (F.col("o_orderstatus") == "P")
    month_src = F.col("l_shipdate") if month_from == "ship" else F.col("o_orderdate")
    source_month = F.trunc(month_src, "MM")

    def mapped(c: str, mapping: dict, other: str) -> Column:
        out = None
        for k, v in mapping.items():
            out = (F.when(F.col(c) == k, F.lit(v)) if out is None else out.when(F.col(c) == k, F.lit(v)))
        return out.otherwise(F.lit(other))

    out = rows.select(
        F.when(listing_blank, F.lit(" ")).otherwise(F.col("l_partkey").cast("string")).alias("listing_id"),
        F.when(host_blank, F.lit("")).otherwise(F.col("o_custkey").cast("string")).alias("host_id"),
        F.col("l_orderkey").cast("string").alias("scrape_id"),
        day_text(F.col("o_orderdate")).alias("scraped_date"),
        F.col("c_name").alias("host_name"),
        mapped("o_orderstatus", SUPERHOST_BY_STATUS, "p").alias("host_is_superhost"),
        F.col("host_neighbourhood"),
        day_text(F.date_add(F.lit(HOST_SINCE_ORIGIN).cast("date"),
                            (F.col("o_custkey") % 3650).cast("int"))).alias("host_since"),
        F.col("s_nation").alias("listing_neighbourhood"),
        F.concat(F.col("p_type"), F.lit(" ")).alias("property_type"),
        F.col("l_returnflag").alias("room_type"),
        (F.col("p_size") % 4).cast("string").alias("accommodates"),
        F.when((F.col("l_linenumber") == 5) & (F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "A"),
               F.lit(""))
         .otherwise(cents_text(F.col("l_price_cents"))).alias("price"),
        F.when(last_line, F.lit("u")).otherwise(mapped("l_linestatus", LINESTATUS_FLAG, "u"))
         .alias("has_availability"),
        F.when((F.col("l_linenumber") == 6) & (F.col("l_returnflag") == "N"), F.lit(" "))
         .otherwise(F.col("l_quantity").cast("string")).alias("availability_30"),
        F.col("l_linenumber").cast("string").alias("number_of_reviews"),
        cents_text(F.col("l_discount_cents")).alias("review_scores_rating"),
        cents_text(F.col("l_tax_cents")).alias("review_scores_accuracy"),
        F.col("p_size").cast("string").alias("review_scores_cleanliness"),
        F.lit("").alias("review_scores_checkin"),
        F.col("s_nationkey").cast("string").alias("review_scores_communication"),
        F.lit(" ").alias("review_scores_value"),
        F.concat(F.lit("listings_"), F.translate(F.substring(day_text(source_month), 1, 7), "-", "_"), F.lit(".csv")).alias("source_file"),
        source_month.alias("source_month"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in AIRBNB_RAW.fields])


def lga_code(t: dict[str, DataFrame]) -> DataFrame:
    """Region codes and names, plus rows with a blank code or name, which cleaning drops."""
    r = t["region"]
    code = (F.lit(10050) + F.col("r_regionkey") * 100).cast("string")
    return (r.select(code.alias("lga_code"), F.col("r_name").alias("lga_name"))
            .unionByName(r.select(F.lit(" ").alias("lga_code"), F.col("r_name").alias("lga_name")))
            .unionByName(r.select(F.col("r_regionkey").cast("string").alias("lga_code"), F.lit("").alias("lga_name")))
            .select(*LGA_CODE.fieldNames()))


def lga_suburb(t: dict[str, DataFrame]) -> DataFrame:
    """Nations under their regions; every tenth nation lies in two, one name per region has no code,
    some names are white space only (kept as '') or empty (dropped)."""
    region, nation = t["region"].select("r_regionkey", "r_name"), t["nation"]
    other = (F.col("n_regionkey") + 1) % 5 == F.col("r_regionkey")
    name, suburb = F.col("r_name").alias("lga_name"), F.col("n_name").alias("suburb_name")
    parts = [
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(name, suburb),
        nation.where("n_nationkey % 10 = 0").join(region, other).select(name, suburb),
        region.select(F.concat(F.lit("no code "), "r_name").alias("lga_name"), F.concat(F.lit("suburb of "), "r_name").alias("suburb_name")),
        nation.where("n_nationkey % 10 = 1").select(F.lit(" ").alias("lga_name"), F.concat("n_name", F.lit(" heights")).alias("suburb_name")),
        region.select(name, F.lit("").alias("suburb_name")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*LGA_SUBURB.fieldNames())


def _odd_census_rows(t: dict[str, DataFrame], columns) -> DataFrame:
    """A null, a blank and short codes (padded by cleaning), with one count and nulls."""
    code = (F.when(F.col("n_regionkey") == 0, F.lit(None)).when(F.col("n_regionkey") == 1, F.lit(" "))
            .otherwise(F.concat(F.lit("LGA"), F.col("n_regionkey").cast("string"))))
    counted = t["nation"].groupBy("n_regionkey").agg(F.count(F.lit(1)).cast("string").alias("n"))
    return counted.select(code.alias("lga_code_2016"), F.col("n").alias(columns[0]),
                          *[F.lit(None).cast("string").alias(c) for c in columns[1:]])


def _region_customers(t: dict[str, DataFrame]) -> DataFrame:
    nation = t["nation"].select("n_nationkey", "n_regionkey")
    return (t["customer"].select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))


def census_g01(t: dict[str, DataFrame]) -> DataFrame:
    """Per-region person counts; an empty band is a null cell (coalesced to 0 downstream)."""
    male = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY")
    aggs = [F.count(F.lit(1)).cast("string").alias("tot_p_p"),
            F.count(F.when(male, 1)).cast("string").alias("tot_p_m"),
            F.count(F.when(~male, 1)).cast("string").alias("tot_p_f")]
    for name, lo, hi in zip(CENSUS_G01_AGE_BANDS, ACCTBAL_BANDS[:-1], ACCTBAL_BANDS[1:]):
        n = F.count(F.when((F.col("c_acctbal") >= lo) & (F.col("c_acctbal") < hi), 1))
        aggs.append(F.nullif(n, F.lit(0)).cast("string").alias(name))
    out = _region_customers(t).groupBy("n_regionkey").agg(*aggs)
    out = out.select(F.concat(F.lit("LGA"), (F.lit(10050) + F.col("n_regionkey") * 100).cast("string"))
                     .alias("lga_code_2016"), *CENSUS_G01_COUNTS, *CENSUS_G01_AGE_BANDS)
    return out.unionByName(_odd_census_rows(t, [*CENSUS_G01_COUNTS, *CENSUS_G01_AGE_BANDS]))


def census_g02(t: dict[str, DataFrame]) -> DataFrame:
    """Per-region averages rendered as text with two decimals (exact integer cents)."""
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint")
    g = _region_customers(t).groupBy("n_regionkey").agg(
        F.sum(cents).alias("s"), F.count(F.lit(1)).alias("n"), F.max(cents).alias("mx"),
        F.count_distinct("c_nationkey").alias("nn"))
    per = F.expr("s div n")
    out = g.select(
        F.concat(F.lit("LGA"), (F.lit(10050) + F.col("n_regionkey") * 100).cast("string")).alias("lga_code_2016"),
        cents_text(F.expr("s div n div 100")).alias("median_age_persons"),
        cents_text(F.col("nn") * 100 + F.lit(50)).alias("average_household_size"),
        cents_text(F.col("mx")).alias("median_mortgage_repay_monthly"),
        cents_text(per).alias("median_rent_weekly"),
        cents_text(per * 2).alias("median_tot_prsnl_inc_weekly"),
    ).select(*CENSUS_G02.fieldNames())
    return out.unionByName(_odd_census_rows(t, CENSUS_G02.fieldNames()[1:]))


def raw_sources(spark: SparkSession, sf_dir: str, month_from: str = "order") -> dict[str, DataFrame]:
    t = load_tables(spark, sf_dir)
    return {
        "airbnb_raw": airbnb_raw(t, month_from=month_from),
        "lga_code": lga_code(t),
        "lga_suburb": lga_suburb(t),
        "census_g01": census_g01(t),
        "census_g02": census_g02(t),
    }
