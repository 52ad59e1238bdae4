"""Silver layer: typed, cleaned and de-duplicated relations.

Every function is DataFrame -> DataFrame.  Cleaning is one narrow projection
(no shuffle); the only shuffles are the per-key de-duplications.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.functions.cleaning import (
    blank_to_null,
    cast_blank,
    census_code,
    default_blank,
    flag_to_bool,
    lower_trim_after_nullif,
    normalise,
    try_cast_blank,
    unparsed,
)
from lodgelake.functions.dates import month_start
from lodgelake.operators.dedup import earliest_per_group, latest_per_group
from lodgelake.sources.schemas import CENSUS_G01_AGE_BANDS

REVIEW_COLUMNS = [
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_value",
]

# Output columns of silver_listing_for_fact, in order; all of them after the date
# also serve as the total tie-break (descending) among rows of the same date.
FACT_SOURCE_COLUMNS = [
    "listing_id", "host_id", "scrape_id", "scraped_date", "month_start", "host_name",
    "host_is_superhost", "host_neighbourhood", "host_since", "listing_neighbourhood",
    "property_type", "room_type", "accommodates", "price", "has_availability", "availability_30",
    "number_of_reviews", *REVIEW_COLUMNS,
]
FACT_TIE_BREAK = [
    "scrape_id", "number_of_reviews", "host_id", "price", "availability_30",
    "review_scores_communication", "room_type", "has_availability", "review_scores_rating",
    "review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
    "review_scores_value", "host_is_superhost", "host_name", "host_neighbourhood", "host_since",
    "listing_neighbourhood", "property_type", "accommodates",
]
PROPERTY_FEED_COLUMNS = ["listing_id", "host_id", "property_type", "room_type", "accommodates",
                         "listing_neighbourhood", "scraped_date"]
HOST_FEED_COLUMNS = ["host_id", "host_name", "host_is_superhost", "host_neighbourhood", "host_since",
                     "scraped_date"]


#: Typed columns of the scrape: text that does not parse fails the load, or is set aside with its row.
TYPED = {"listing_id": "bigint", "host_id": "bigint", "scrape_id": "bigint", "scraped_date": "date", "accommodates": "int",
         "price": "decimal(12,2)", "availability_30": "int", "number_of_reviews": "int", **{c: "decimal(5,2)" for c in REVIEW_COLUMNS}}
CLEAN_COLUMNS = ["listing_id", "host_id", "scrape_id", "scraped_date", "host_name", "host_is_superhost", "host_neighbourhood", "host_since",
                 "listing_neighbourhood", "property_type", "room_type", "accommodates", "price", "has_availability", "availability_30",
                 "number_of_reviews", *REVIEW_COLUMNS, "source_file", "source_month"]


def _cleaned(airbnb: DataFrame, months: Sequence[str] | None, cast: Callable, extra: Sequence[Column] = ()) -> DataFrame:
    """Rows with a key, typed by ``cast`` and normalised, and what ``extra`` adds."""
    src = airbnb
    if months:
        src = src.where(F.col("source_month").isin([F.lit(m).cast("date") for m in months]))
    keyed = src.where((F.trim("listing_id") != "") | (F.trim("host_id") != ""))
    made = {
        **{c: cast(c, dtype) for c, dtype in TYPED.items()},
        "host_name": blank_to_null("host_name"), "host_is_superhost": flag_to_bool("host_is_superhost"),
        "host_neighbourhood": normalise("host_neighbourhood"), "host_since": blank_to_null("host_since"),
        "listing_neighbourhood": normalise("listing_neighbourhood"), "property_type": normalise("property_type"),
        "room_type": normalise("room_type"), "has_availability": flag_to_bool("has_availability"),
    }
    return keyed.select(*[made.get(c, F.col(c)).alias(c) for c in CLEAN_COLUMNS], *extra)


def _strict(c: str, dtype: str) -> Column:
    return F.col(c).cast(dtype) if dtype == "date" else cast_blank(c, dtype)


def silver_airbnb_clean(airbnb: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Cast and normalise, drop keyless rows, keep rows scraped in their load month.

    Non-blank text that does not parse fails the load; ``silver_airbnb_judged`` sets it aside instead.
    ``months`` restricts to given load months (``'YYYY-MM-01'``) as a literal
    predicate on ``source_month``, which prunes partitions of a month-partitioned
    source; the column-to-column month guard itself cannot prune anything.
    """
    return _cleaned(airbnb, months, _strict).where(month_start("scraped_date") == F.col("source_month"))


def silver_airbnb_judged(airbnb: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """The same rows with ``errors``, the (column, raw text) pairs that do not parse; [] in clean rows.

    One pass over the source gives both kinds of rows: ``clean_rows`` and ``rejected_values`` take them apart, and
    ``sources.sinks.write_table`` partitioned by ``rejected`` writes both at once.
    """
    wrong = F.filter(F.array(*[F.when(unparsed(c, dtype), F.struct(F.lit(c).alias("column_name"), F.col(c).alias("raw_text")))
                               for c, dtype in TYPED.items()]), lambda e: e.isNotNull())
    keys = F.struct(*[F.col(c).alias(c) for c in REJECT_KEYS])
    judged = _cleaned(airbnb, months, try_cast_blank, [wrong.alias("errors"), keys.alias("raw")])
    rejected = F.size("errors") > 0
    return judged.withColumn("rejected", rejected).where(rejected | (month_start("scraped_date") == F.col("source_month")))


REJECT_KEYS = ["listing_id", "host_id", "scrape_id", "scraped_date"]


def clean_rows(judged: DataFrame) -> DataFrame:
    """The rows without errors, as ``silver_airbnb_clean`` has them."""
    return judged.where(~F.col("rejected")).select(*CLEAN_COLUMNS)


def rejected_values(judged: DataFrame) -> DataFrame:
    """One row per value that does not parse: raw keys of its row, source, column and raw text."""
    return judged.where("rejected").select("raw.*", "source_file", "source_month", F.explode("errors").alias("e")).select(
        *REJECT_KEYS, "source_file", "source_month", "e.column_name", "e.raw_text")


def silver_host(clean: DataFrame, literal: bool = False) -> DataFrame:
    """One row per (host_id, scraped_date).

    ``literal=True`` reproduces the reference's ``host_is_superhost::text in ('t')``
    test on an already-boolean column, which turns every true into false (T1).
    """
    flag = F.col("host_is_superhost")
    if literal:
        flag = flag.cast("string").isin("t")
    src = clean.where(F.col("host_id").isNotNull()).select(
        "host_id",
        default_blank("host_name").alias("host_name"),
        flag.alias("host_is_superhost"),
        normalise("host_neighbourhood").alias("host_neighbourhood"),
        "host_since",
        F.col("scraped_date").cast("date").alias("scraped_date"),
    )
    return src.groupBy("host_id", "scraped_date").agg(
        F.bool_or("host_is_superhost").alias("host_is_superhost"),
        F.max("host_name").alias("host_name"),
        F.max("host_neighbourhood").alias("host_neighbourhood"),
        F.max("host_since").alias("host_since"),
    )


def silver_listing(clean: DataFrame) -> DataFrame:
    """Typed listing rows with their month; no de-duplication."""
    return clean.where(F.col("listing_id").isNotNull()).select(
        "listing_id", "host_id", "property_type", "room_type", "accommodates",
        "listing_neighbourhood", "price", "has_availability", "availability_30",
        "number_of_reviews", *REVIEW_COLUMNS,
        F.col("scraped_date").cast("timestamp_ntz").alias("scraped_date"),
        month_start("scraped_date").alias("month"),
    )


def silver_listing_for_fact(clean: DataFrame, columns: Sequence[str] = FACT_SOURCE_COLUMNS) -> DataFrame:
    """The latest row per (listing_id, month).

    Of ``columns`` only, it moves fewer bytes: the tie-break ends with the last of them, since rows that agree up to there
    agree in all of them, and the values are those of the whole tie-break's row.
    """
    src = (clean.where(F.col("listing_id").isNotNull())
           .where(month_start("scraped_date") == F.col("source_month"))
           .withColumn("month_start", month_start("scraped_date")))
    wanted = [n for n, c in enumerate(FACT_TIE_BREAK, 1) if c in columns]
    latest = latest_per_group(src, ["listing_id", "month_start"], "scraped_date", FACT_TIE_BREAK[:max(wanted, default=0)])
    return latest.select(*[c for c in FACT_SOURCE_COLUMNS if c in columns])


def host_feed(host: DataFrame) -> DataFrame:
    """The *earliest* row per (host_id, month) of ``silver_host``."""
    base = host.where(F.col("host_id").isNotNull()).select(
        "host_id", default_blank("host_name").alias("host_name"), "host_is_superhost",
        normalise("host_neighbourhood").alias("host_neighbourhood"), "host_since",
        F.col("scraped_date").cast("date").alias("scraped_date"),
        month_start("scraped_date").alias("month_start"))
    return earliest_per_group(base, ["host_id", "month_start"], "scraped_date").select(*HOST_FEED_COLUMNS)


def property_feed(listing: DataFrame, columns: Sequence[str] = PROPERTY_FEED_COLUMNS) -> DataFrame:
    """The *latest* row per (listing_id, month) of ``silver_listing``; of ``columns`` only, as the facts' source."""
    base = listing.where(F.col("listing_id").isNotNull()).select(
        "listing_id", "host_id",
        normalise("property_type").alias("property_type"),
        normalise("room_type").alias("room_type"),
        # no cast where there is nothing to cast: Spark drops its alias in one reader of the feed only, and then no longer
        # sees that two readers ask for the same exchange
        F.col("accommodates") if dict(listing.dtypes)["accommodates"] == "int" else F.col("accommodates").cast("int").alias("accommodates"),
        normalise("listing_neighbourhood").alias("listing_neighbourhood"),
        F.col("scraped_date").cast("date").alias("scraped_date"),
        month_start("scraped_date").alias("month_start"))
    tie = ["host_id", "property_type", "room_type", "accommodates", "listing_neighbourhood"]
    wanted = [n for n, c in enumerate(tie, 1) if c in columns]
    return latest_per_group(base, ["listing_id", "month_start"], "scraped_date", tie[:max(wanted, default=0)]).select(
        *[c for c in PROPERTY_FEED_COLUMNS if c in columns])


def silver_lga_code_clean(lga_code: DataFrame) -> DataFrame:
    """Distinct (lga_code, lga_name), both lower-cased, blanks dropped."""
    return (lga_code.where(blank_to_null("lga_code").isNotNull() & blank_to_null("lga_name").isNotNull())
            .select(F.nullif(F.trim(F.lower("lga_code")), F.lit("")).alias("lga_code"),
                    F.nullif(F.trim(F.lower("lga_name")), F.lit("")).alias("lga_name"))
            .distinct())


def silver_lga_suburb_clean(lga_suburb: DataFrame) -> DataFrame:
    """Distinct (lga_name, suburb_name); whitespace-only names survive as '' (T5)."""
    raw = lga_suburb.select(lower_trim_after_nullif("lga_name").alias("lga_name"),
                            lower_trim_after_nullif("suburb_name").alias("suburb_name"))
    return raw.where(F.col("lga_name").isNotNull() & F.col("suburb_name").isNotNull()).distinct()


def silver_lga(suburbs: DataFrame, codes: DataFrame) -> DataFrame:
    """Suburb -> (lga_code, lga_name) through the cleaned LGA name, distinct."""
    c = codes.select("lga_code", F.lower("lga_name").alias("lga_name_norm"))
    r = suburbs.select(F.col("lga_name").alias("lga_name_norm"), "suburb_name")
    return (r.join(c, "lga_name_norm", "left")
            .select("suburb_name", "lga_code", F.col("lga_name_norm").alias("lga_name"))
            .distinct())


def silver_census_g01_clean(g01: DataFrame) -> DataFrame:
    """Population totals (nulls kept) and age bands (null -> 0) by 5-digit code."""
    out = g01.select(
        census_code("lga_code_2016").alias("lga_code"),
        F.col("tot_p_p").cast("bigint").alias("population_total"),
        F.col("tot_p_m").cast("bigint").alias("population_male"),
        F.col("tot_p_f").cast("bigint").alias("population_female"),
        *[F.coalesce(F.col(src).cast("bigint"), F.lit(0).cast("bigint")).alias(dst)
          for src, dst in zip(CENSUS_G01_AGE_BANDS, CENSUS_AGE_OUTPUT)],
    )
    return out.where(F.col("lga_code").isNotNull())


CENSUS_AGE_OUTPUT = ["age_0_4_p", "age_5_14_p", "age_15_19_p", "age_20_24_p", "age_25_34_p",
                     "age_35_44_p", "age_45_54_p", "age_55_64_p", "age_65_74_p", "age_75_84_p",
                     "age_85_plus_p"]


def silver_census_g02_clean(g02: DataFrame) -> DataFrame:
    """Census medians/averages by 5-digit code; blank codes dropped first."""
    return g02.where(blank_to_null("lga_code_2016").isNotNull()).select(
        census_code("lga_code_2016").alias("lga_code"),
        F.col("median_age_persons").cast("decimal(5,2)").alias("median_age_persons"),
        F.col("average_household_size").cast("decimal(5,2)").alias("average_household_size"),
        F.col("median_mortgage_repay_monthly").cast("decimal(10,2)").alias("median_mortgage_repay_monthly"),
        F.col("median_rent_weekly").cast("decimal(10,2)").alias("median_rent_weekly"),
        F.col("median_tot_prsnl_inc_weekly").cast("decimal(10,2)").alias("median_personal_income_weekly"),
    )
