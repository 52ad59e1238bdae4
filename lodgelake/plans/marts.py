"""Gold marts (R27-R29): monthly panels with exact rates, prices and month-over-month change.

Every mart is built in two parts.

* The *panel* is month-local: facts of a month meet the versions of that month (equi-join on key and
  month, the partition columns of both tables), and the joined rows are aggregated in one chain.
  Listings, hosts and prices of a group are *facets* of its rows.  A fact is the only one of its listing and
  month, so inside the calendar listings are added up where they lie; hosts meet their versions as rows of
  (host, month, group) and are folded where that join left them.  Only prices, and the listings and hosts of the
  null month, move with an id: one partial aggregate per (group, facet, id) folds them first.  The second level
  counts ids and keeps the digit ranges of prices, the third adds up a group and picks its median
  (``operators.median``).  Nothing is joined back.
* The *mart* adds the change against the previous present month (``lag`` over the panel, one row
  per group and month), names, published types and the order.

``months`` (a DataFrame of dates) restricts a panel to some months: a semi-join that Spark turns
into partition pruning on both sides of the version join.  Money is added up in whole cents (``functions.numeric``);
counts are ``bigint``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions.dates import date_from_id
from lodgelake.functions.numeric import cents, cents_ratio, from_cents, mean_cents, pct_change, ratio_pct
from lodgelake.operators.dedup import asc
from lodgelake.operators.joins import month_version_join
from lodgelake.operators.lookup import lga_lookup_table, priority_lookup
from lodgelake.operators.median import leading_digits, middle, value_list

# Fixed value: a month has 30 bookable nights in the reference's stay estimate.
NIGHTS = 30

FIRST_DAY = "0001-01-01"  # of Spark's dates

# Facets of a panel's rows.
LISTING, HOST, PRICE = 0, 1, 2


def stays_active(active: Column, availability: Column) -> Column:
    """``case when active then greatest(0, 30 - availability_30) else 0 end`` (null flag -> 0)."""
    return F.when(active, F.greatest(F.lit(0), F.lit(NIGHTS) - availability)).otherwise(F.lit(0))


def revenue_active(active: Column, availability: Column, price: Column) -> Column:
    """Stays times price when active, else 0; null price gives null (skipped by sums)."""
    nights = F.greatest(F.lit(0), F.lit(NIGHTS) - availability)
    return F.when(active, nights * price).otherwise(F.lit(0))


def _of_months(df: DataFrame, months: DataFrame | None) -> DataFrame:
    """Rows of the given months (column ``month``, a date each); of a month-partitioned table only their files are listed.

    Spark prunes partitions at run time only by a side with a comparison in it: hence the bound below all dates.
    """
    if months is None:
        return df
    some = months.select("month").where(F.col("month") >= F.lit(FIRST_DAY).cast("date")).distinct()
    return df.join(F.broadcast(some), "month", "left_semi")


def _dated(fact: DataFrame) -> DataFrame:
    """Facts with the day (``on_day``) and month (``month_start``) of their calendar row.

    Every ``date_id`` is the ``yyyyMMdd`` of a calendar day (or null outside the
    calendar), so the day and its month follow by arithmetic -- the same values the
    left join returns, with no join at all.
    """
    day = date_from_id("date_id")
    return fact.withColumn("on_day", day).withColumn("month_start", F.when(F.col("date_id").isNotNull(), F.col("month")))


def _changes(panel: DataFrame, group: Sequence[str], measures: dict[str, str]) -> DataFrame:
    by_month = Window.partitionBy(*group).orderBy(asc("month_start"))
    return panel.withColumns({out: pct_change(F.col(src), F.lag(src).over(by_month)) for src, out in measures.items()})


# Published types: money and review averages as the warehouse has them; percentages and the
# warehouse's unbounded numerics in a type that cannot overflow.
MONEY, SCORE, WIDE = "decimal(14,2)", "decimal(6,2)", "decimal(18,2)"


def _as(c, kind: str) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast(kind)


def _facets(rows: DataFrame, keys: Sequence[str], ids: Sequence[Column], flags: dict[str, dict[int, Column]],
            sums: dict[str, Column]) -> DataFrame:
    """One row per (keys, facet, id): ``ids[k]`` is the id in facet k, ``flags`` are any-of per facet, ``sums`` belong
    to the listings; ``rows_n`` counts the rows.  Rows without a price are no part of the price facet."""
    facet = F.col("facet")

    def pick(by_facet: dict[int, Column]) -> Column:
        out = None
        for k, c in by_facet.items():
            out = F.when(facet == k, c) if out is None else out.when(facet == k, c)
        return out

    copied = rows.withColumn("facet", F.explode(F.array(*[F.lit(k) for k in range(len(ids))])))
    narrow = copied.select(*keys, "facet", pick({k: c.cast("bigint") for k, c in enumerate(ids)}).alias("id"),
                           *[pick(by_facet).alias(name) for name, by_facet in flags.items()],
                           *[F.when(facet == LISTING, c).alias(name) for name, c in sums.items()])
    return narrow.where((facet != PRICE) | F.col("id").isNotNull()).groupBy(*keys, "facet", "id").agg(
        *[F.bool_or(name).alias(name) for name in flags],
        *[part for name in sums for part in (F.sum(name).alias(name), F.count(name).alias(f"{name}_n"))],
        F.count(F.lit(1)).alias("rows_n"))


def _ids(facet: int, flag: str | None = None) -> Column:
    """Number of the group's ids in a facet, of those with a flag only."""
    chosen = F.col("facet") == facet if flag is None else (F.col("facet") == facet) & F.col(flag)
    return F.count(F.when(chosen, F.col("id")))


def _big(name: str) -> Column:
    return F.sum(F.col(name).cast("decimal(38,0)"))


def _unless_dated(c: str) -> Column:
    """The id where rows of several months meet (in the null month), null where it has one row a group anyway."""
    return F.when(F.col("month_start").isNull(), F.col(c).cast("bigint"))


def _host_rows(facts: DataFrame, hosts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hosts of the facts' groups, flagged where a version of theirs that holds in the month is a superhost's.

    Versions are one month long, so the month's first day asks for the version of all its days.
    """
    rows = facts.where(F.col("host_id").isNotNull()).select("host_id", "month", *keys)
    found = month_version_join(rows, hosts, "host_id", "month_start", ["host_is_superhost"], null_keys=False)
    one = found.groupBy("host_id", "month", *keys).agg(F.bool_or(F.coalesce("host_is_superhost", F.lit(False))).alias("flag"))
    return one.select(*keys, F.lit(HOST).alias("facet"), _unless_dated("host_id").alias("id"), "flag")


def _listing_rows(measured: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Listings of the groups with their flags and sums, and their prices; ``measured`` has one row per listing and group,
    in the null month also several."""
    facet = F.col("facet")
    facets = F.when(F.col("price").isNotNull(), F.array(F.lit(LISTING), F.lit(PRICE))).otherwise(F.array(F.lit(LISTING)))
    return measured.withColumn("facet", F.explode(facets)).select(
        *keys, "facet", F.when(facet == PRICE, F.col("price").cast("bigint")).otherwise(_unless_dated("listing_id")).alias("id"),
        *[F.when(facet == LISTING, c).alias(name) for name, c in (("flag", F.col("active")), ("idle", ~F.col("active")))],
        *[F.when(facet == LISTING, F.col(name)).alias(name) for name in sums])


def _folded(rows: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """One row per (keys, facet, id): numbers of rows, of flagged and of idle ones, sums with their numbers of terms.

    Sums of a whole group fit a long (review cents, nights) but for money, which is added up as a decimal.
    """
    return rows.groupBy(*keys, "facet", "id").agg(
        F.count(F.lit(1)).alias("rows_n"), F.count_if("flag").alias("flag_n"), F.count_if("idle").alias("idle_n"),
        *[part for name in sums for part in ((_big(name) if name == MONEY_SUM else F.sum(name)).alias(name), F.count(name).alias(f"{name}_n"))])


def _number(facet: int, rows: str) -> Column:
    """Number of a group's listings or hosts that have such rows: a row without an id stands for one each, an id counts once."""
    n = F.when(F.col("id").isNull(), F.col(rows)).otherwise(F.least(F.col(rows), F.lit(1)))
    return F.coalesce(F.sum(F.when(F.col("facet") == facet, n)), F.lit(0))


MONEY_SUM = "revenue"
SUMS = ["review", "stays", MONEY_SUM]
COUNTS = {"n_listings": (LISTING, "rows_n"), "n_active": (LISTING, "flag_n"), "n_inactive": (LISTING, "idle_n"),
          "n_hosts": (HOST, "rows_n"), "n_superhosts": (HOST, "flag_n")}


def _panel(listings: DataFrame, hosts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The groups of a panel from its listing and host rows: counts, sums with their numbers of terms, and price statistics in cents."""
    facets = _folded(listings.unionByName(hosts, allowMissingColumns=True), keys, SUMS)
    part = F.when(F.col("facet") == PRICE, leading_digits("id")).otherwise(F.lit(0))
    price = F.when(F.col("facet") == PRICE, F.col("id"))
    parts = facets.groupBy(*keys, "facet", part.alias("part")).agg(
        *[_number(*of).alias(name) for name, of in COUNTS.items()],
        *[c for name in SUMS for c in (_big(name).alias(name), F.sum(f"{name}_n").alias(f"{name}_n"))],
        F.min(price).alias("price_min"), F.max(price).alias("price_max"),
        F.sum(price.cast("decimal(38,0)") * F.col("rows_n")).cast("decimal(38,0)").alias("price_sum"),
        F.sum(F.when(price.isNotNull(), F.col("rows_n"))).alias("price_n"),
        value_list(price, "rows_n").alias("prices"))
    # facets in order put the prices last; other facets have no rows to count there
    placed = parts.withColumn("place", F.struct("facet", "part"))
    low, high = middle(keys, "place", "price_n", "prices")
    each = placed.select(*keys, *COUNTS, *SUMS, *[f"{s}_n" for s in SUMS], "price_min", "price_max", "price_sum", "price_n",
                         low.alias("price_low"), high.alias("price_high"))
    return each.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in COUNTS],
        *[c for name in SUMS for c in (F.sum(name).alias(name), F.sum(f"{name}_n").alias(f"{name}_n"))],
        F.min("price_min").alias("price_min"), F.max("price_max").alias("price_max"), F.sum("price_sum").alias("price_sum"),
        F.sum("price_n").alias("price_n"), (F.max("price_low") + F.max("price_high")).alias("price_middles"))


LISTING_MART_KEYS = ["month_start", "suburb_id"]


#: Columns of the facts that the panels need.
LISTING_FACTS = ["listing_id", "host_id", "suburb_id", "date_id", "price", "has_availability", "availability_30", "review_scores_rating"]
HOST_FACTS = ["listing_id", "host_id", "date_id", "price", "has_availability", "availability_30"]
PROPERTY_FACTS = ["listing_id", "host_id", "date_id", "price", "has_availability", "availability_30", "review_scores_rating"]


def listing_panel(fact: DataFrame, hosts: DataFrame, months: DataFrame | None = None, dated: bool = False) -> DataFrame:
    """Month x listing suburb (by id: ``suburb_id`` is md5 of the name, one id per name); ``dated`` says that the calendar holds all facts."""
    facts = _dated(_of_months(fact.select("month", *LISTING_FACTS), months))
    active, pair = F.col("has_availability"), [*LISTING_MART_KEYS, "listing_id", "host_id"]
    measured = facts.select(
        *pair, active.alias("active"),
        F.when(active, cents("price")).alias("price"), F.when(active, cents("review_scores_rating")).alias("review"),
        stays_active(active, F.col("availability_30")).cast("bigint").alias("stays"),
        revenue_active(active, F.col("availability_30"), cents("price")).alias("revenue"))
    if not dated:
        # listing and host have several facts in the null month, and one that is all of them in any other
        undated = measured.where(F.col("month_start").isNull()).groupBy(*pair).agg(
            F.bool_or("active").alias("active"), mean_cents(F.sum("price"), F.count("price")).alias("price"),
            mean_cents(F.sum("review"), F.count("review")).alias("review"), F.sum("stays").alias("stays"), F.sum("revenue").alias("revenue"))
        measured = measured.where(F.col("month_start").isNotNull()).unionByName(undated)
    return _panel(_listing_rows(measured, LISTING_MART_KEYS, SUMS), _host_rows(facts, _of_months(hosts, months), LISTING_MART_KEYS), LISTING_MART_KEYS)


def dm_listing_neighbourhood(panel: DataFrame, suburbs: DataFrame) -> DataFrame:
    """Month x listing neighbourhood, from its panel; the name is attached to one row per group."""
    panel = _changes(panel, ["suburb_id"], {"n_active": "pct_change_active_listings", "n_inactive": "pct_change_inactive_listings"})
    # Both sides are per-suburb now; the planner/AQE picks the join from their real sizes.
    names = suburbs.select("suburb_id", F.col("suburb_name").alias("listing_neighbourhood"))
    return panel.join(names, "suburb_id", "left").select(
        "month_start", "listing_neighbourhood",
        _as(ratio_pct("n_active", "n_listings"), WIDE).alias("active_listing_rate_pct"),
        F.col("n_hosts").cast("bigint").alias("distinct_hosts"),
        _as(ratio_pct("n_superhosts", "n_hosts"), WIDE).alias("superhost_rate_pct"),
        _as(from_cents("price_min"), MONEY).alias("min_price_active"),
        _as(from_cents("price_max"), MONEY).alias("max_price_active"),
        _as(cents_ratio("price_sum", "price_n"), MONEY).alias("avg_price_active"),
        _as(cents_ratio("price_middles", F.lit(2)), MONEY).alias("median_price_active"),
        _as(cents_ratio("review", "review_n"), SCORE).alias("avg_review_score_active"),
        F.col("stays").cast("bigint").alias("total_stays_active"),
        _as(cents_ratio("revenue", "n_active"), MONEY).alias("avg_est_revenue_per_active_listing"),
        _as("pct_change_active_listings", WIDE).alias("pct_change_active_listings"),
        _as("pct_change_inactive_listings", WIDE).alias("pct_change_inactive_listings"),
    ).orderBy(asc("listing_neighbourhood"), asc("month_start"))


HOST_MART_KEYS = ["month_start", "host_neighbourhood_lga", "host_neighbourhood_lga_code"]


def host_panel(fact: DataFrame, hosts: DataFrame, lga: DataFrame, override_rows: DataFrame, literal: bool = False,
               months: DataFrame | None = None) -> DataFrame:
    """Month x host LGA (suburb match, then LGA-name match, then override)."""
    facts = _dated(_of_months(fact.select("month", *HOST_FACTS), months))
    facts = month_version_join(facts, _of_months(hosts, months), "host_id", "on_day", ["host_neighbourhood"])
    placed = priority_lookup(facts.withColumn("neighbourhood", F.lower(F.trim("host_neighbourhood"))), "neighbourhood",
                             lga_lookup_table(lga, override_rows, literal=literal))
    active = F.col("has_availability")
    facets = _facets(placed, HOST_MART_KEYS, [F.col("listing_id"), F.col("host_id")], {"flag": {LISTING: active}},
                     {"revenue": revenue_active(active, F.col("availability_30"), cents("price"))})
    return facets.groupBy(*HOST_MART_KEYS).agg(
        _ids(LISTING, "flag").alias("n_active"), _ids(HOST).alias("n_hosts"), _big("revenue").alias("revenue"))


def dm_host_neighbourhood(panel: DataFrame) -> DataFrame:
    """Month x host LGA, from its panel."""
    return panel.select(
        *HOST_MART_KEYS, F.col("n_hosts").cast("bigint").alias("distinct_hosts"),
        _as(cents_ratio("revenue", "n_active"), MONEY).alias("est_revenue_per_active_listing"),
        _as(cents_ratio("revenue", "n_hosts"), MONEY).alias("est_revenue_per_host"),
    ).orderBy(asc("host_neighbourhood_lga"), asc("month_start"))


PROPERTY_GROUP = ["property_type", "room_type", "accommodates"]
PROPERTY_KEYS = ["month_start", *PROPERTY_GROUP]


def property_panel(fact: DataFrame, properties: DataFrame, hosts: DataFrame, months: DataFrame | None = None) -> DataFrame:
    """Month x property type x room type x accommodates, attributes as of each fact."""
    facts = _dated(_of_months(fact.select("month", *PROPERTY_FACTS), months))
    facts = month_version_join(facts, _of_months(properties, months), "listing_id", "on_day", PROPERTY_GROUP, null_keys=False)
    active = F.col("has_availability")
    measured = facts.select(
        *PROPERTY_KEYS, "listing_id", active.alias("active"), F.when(active, cents("price")).alias("price"),
        F.when(active, cents("review_scores_rating")).alias("review"), stays_active(active, F.col("availability_30")).alias("stays"),
        F.when(active, revenue_active(active, F.col("availability_30"), cents("price"))).alias("revenue"))
    return _panel(_listing_rows(measured, PROPERTY_KEYS, SUMS), _host_rows(facts, _of_months(hosts, months), PROPERTY_KEYS), PROPERTY_KEYS)


def dm_property_type(panel: DataFrame) -> DataFrame:
    """Month x property type x room type x accommodates, from its panel."""
    panel = _changes(panel, PROPERTY_GROUP, {"n_active": "pct_change_active_listings_mom", "n_inactive": "pct_change_inactive_listings_mom"})
    measures = {
        "min_price_active": from_cents("price_min"), "max_price_active": from_cents("price_max"),
        "avg_price_active": cents_ratio("price_sum", "price_n"), "median_price_active": cents_ratio("price_middles", F.lit(2)),
        "avg_review_score_active": cents_ratio("review", "review_n"),
        "avg_est_revenue_per_active_listing": cents_ratio("revenue", "revenue_n"),
        "pct_change_active_listings_mom": F.col("pct_change_active_listings_mom"),
        "pct_change_inactive_listings_mom": F.col("pct_change_inactive_listings_mom"),
    }
    return panel.select(
        *PROPERTY_KEYS,
        _as(ratio_pct("n_active", "n_listings"), WIDE).alias("active_listings_rate_pct"),
        F.col("n_hosts").cast("bigint").alias("distinct_hosts"),
        _as(ratio_pct("n_superhosts", "n_hosts"), WIDE).alias("superhost_rate_pct"),
        F.col("stays").cast("bigint").alias("total_stays_active"),
        *[_as(c, WIDE).alias(name) for name, c in measures.items()],
    ).orderBy(*[asc(k) for k in PROPERTY_GROUP], asc("month_start"))
