"""The whole model as one object of lazily built relations.

``RentalModel(spark, sources)`` exposes every relation of the reference as an
attribute; each is built on first use from its upstream attributes, so the
Python attribute graph *is* the dependency graph (no scheduler).  Nothing runs
until an action.  ``plans.build`` materialises the table layers in order by
setting ``materialize``: each table is written once and read back, so downstream
relations start from the written files (lineage cut, restartable).
"""

from __future__ import annotations

from collections.abc import Callable, Container, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lodgelake.operators.calendar import DEFAULT_BOUNDS, calendar, calendar_from_data, dim_date
from lodgelake.operators.lookup import overrides
from lodgelake.plans import bronze, marts, silver, star

Materializer = Callable[[str, DataFrame], DataFrame]


class RentalModel:
    def __init__(self, spark: SparkSession, sources: dict[str, DataFrame],
                 calendar_bounds: tuple[str, str] | str = DEFAULT_BOUNDS,
                 literal: bool = False, materialize: Materializer | None = None, stored: Container[str] | None = None):
        """
        sources: raw ``airbnb_raw``, ``lga_code``, ``lga_suburb``, ``census_g01``, ``census_g02``.
        calendar_bounds: (start, end) dates, or ``"data"`` for whole years covering the scrapes.
        literal: reproduce the reference's two defects (T1 superhost text test, T2 LGA fan-out).
        materialize: ``(name, df) -> df`` hook applied to every table-materialised relation.
        stored: names of the tables that the hook writes (default: all of them, none without a hook).
        """
        self.spark = spark
        self.sources = sources
        self.calendar_bounds = calendar_bounds
        self.literal = literal
        self._materialize = materialize
        self._stored = stored if stored is not None else TABLES if materialize else []

    def _table(self, name: str, df: DataFrame) -> DataFrame:
        return self._materialize(name, df) if self._materialize else df

    # bronze (R1-R5): pass-through copies of the sources
    @cached_property
    def airbnb(self) -> DataFrame:
        return self._table("airbnb", bronze.copy(self.sources["airbnb_raw"]))

    @cached_property
    def lga_code(self) -> DataFrame:
        return self._table("lga_code", bronze.copy(self.sources["lga_code"]))

    @cached_property
    def lga_suburb(self) -> DataFrame:
        return self._table("lga_suburb", bronze.copy(self.sources["lga_suburb"]))

    @cached_property
    def census_g01(self) -> DataFrame:
        return self._table("census_g01", bronze.copy(self.sources["census_g01"]))

    @cached_property
    def census_g02(self) -> DataFrame:
        return self._table("census_g02", bronze.copy(self.sources["census_g02"]))

    # silver
    @cached_property
    def silver_airbnb_clean(self) -> DataFrame:
        return self._table("silver_airbnb_clean", silver.silver_airbnb_clean(self.airbnb))

    @cached_property
    def silver_host(self) -> DataFrame:
        return self._table("silver_host", silver.silver_host(self.silver_airbnb_clean, literal=self.literal))

    @cached_property
    def silver_listing(self) -> DataFrame:
        return self._table("silver_listing", silver.silver_listing(self.silver_airbnb_clean))

    @cached_property
    def silver_listing_for_fact(self) -> DataFrame:
        return self._table("silver_listing_for_fact", silver.silver_listing_for_fact(self.silver_airbnb_clean))

    @cached_property
    def silver_host_for_snapshot(self) -> DataFrame:
        return silver.host_feed(self.silver_host)

    @cached_property
    def silver_property_for_snapshot(self) -> DataFrame:
        return silver.property_feed(self.silver_listing)

    @cached_property
    def silver_lga_code_clean(self) -> DataFrame:
        return self._table("silver_lga_code_clean", silver.silver_lga_code_clean(self.lga_code))

    @cached_property
    def silver_lga_suburb_clean(self) -> DataFrame:
        return self._table("silver_lga_suburb_clean", silver.silver_lga_suburb_clean(self.lga_suburb))

    @cached_property
    def silver_lga(self) -> DataFrame:
        return self._table("silver_lga", silver.silver_lga(self.silver_lga_suburb_clean,
                                                           self.silver_lga_code_clean))

    @cached_property
    def silver_census_g01_clean(self) -> DataFrame:
        return self._table("silver_census_g01_clean", silver.silver_census_g01_clean(self.census_g01))

    @cached_property
    def silver_census_g02_clean(self) -> DataFrame:
        return self._table("silver_census_g02_clean", silver.silver_census_g02_clean(self.census_g02))

    # snapshots
    @cached_property
    def host_snapshot(self) -> DataFrame:
        return self._table("host_snapshot", star.host_snapshot(self.silver_host_for_snapshot))

    @cached_property
    def property_snapshot(self) -> DataFrame:
        # the feed that silver_property_for_snapshot shows, of the columns that the snapshot keeps
        feed = silver.property_feed(self.silver_listing, star.PROPERTY_SNAPSHOT_COLUMNS)
        return self._table("property_snapshot", star.property_snapshot(feed))

    # gold star
    @cached_property
    def dim_date(self) -> DataFrame:
        if self.calendar_bounds == "data":
            days = calendar_from_data(self.silver_airbnb_clean, "scraped_date")
        else:
            days = calendar(self.spark, *self.calendar_bounds)
        return self._table("dim_date", dim_date(days))

    @cached_property
    def host_versions(self) -> DataFrame:
        """``dim_host`` with the month that it is stored by."""
        return self._table("dim_host", star.dim_host(self.host_snapshot))

    @cached_property
    def dim_host(self) -> DataFrame:
        return self.host_versions.select(*star.DIM_HOST_COLUMNS)

    @cached_property
    def property_versions(self) -> DataFrame:
        """``dim_property`` with the month that it is stored by."""
        return self._table("dim_property", star.dim_property(self.property_snapshot))

    @cached_property
    def dim_property(self) -> DataFrame:
        return self.property_versions.select(*star.DIM_PROPERTY_COLUMNS)

    @cached_property
    def dim_suburb(self) -> DataFrame:
        return self._table("dim_suburb", star.dim_suburb(self.silver_listing))

    @cached_property
    def listing_facts(self) -> DataFrame:
        """``fact_listings`` with the month that it is stored by."""
        return self._table("fact_listings", star.fact_listings(self.silver_listing_for_fact, self._bounds))

    @property
    def _bounds(self) -> tuple[str, str] | None:
        return None if self.calendar_bounds == "data" else tuple(self.calendar_bounds)

    def facts_of(self, columns: Sequence[str]) -> DataFrame:
        """``listing_facts`` for plans that need some columns only: facts that are no table are made of what those need."""
        if "fact_listings" in self._stored or "silver_listing_for_fact" in self._stored:
            return self.listing_facts
        needed = ["listing_id", "month_start", *[star.FACT_SOURCES.get(c, c) for c in columns]]
        return star.fact_listings(silver.silver_listing_for_fact(self.silver_airbnb_clean, needed), self._bounds, columns)

    @cached_property
    def fact_listings(self) -> DataFrame:
        return self.listing_facts.select(*star.FACT_COLUMNS)

    @cached_property
    def ref_lga(self) -> DataFrame:
        return self._table("ref_lga", star.ref_lga(self.silver_lga))

    @cached_property
    def ref_census_g01(self) -> DataFrame:
        return self._table("ref_census_g01", self.silver_census_g01_clean)

    @cached_property
    def ref_census_g02(self) -> DataFrame:
        return self._table("ref_census_g02", self.silver_census_g02_clean)

    # gold marts (views: always lazy)
    @cached_property
    def lga_overrides(self) -> DataFrame:
        return overrides(self.spark)

    def listing_panel(self, months: DataFrame | None = None) -> DataFrame:
        return marts.listing_panel(self.facts_of(marts.LISTING_FACTS), self.host_versions, months, dated=self.calendar_bounds == "data")

    def host_panel(self, months: DataFrame | None = None) -> DataFrame:
        return marts.host_panel(self.facts_of(marts.HOST_FACTS), self.host_versions, self.ref_lga, self.lga_overrides, self.literal, months)

    def property_panel(self, months: DataFrame | None = None) -> DataFrame:
        return marts.property_panel(self.facts_of(marts.PROPERTY_FACTS), self.property_versions, self.host_versions, months)

    @cached_property
    def dm_listing_neighbourhood(self) -> DataFrame:
        return marts.dm_listing_neighbourhood(self.listing_panel(), self.dim_suburb)

    @cached_property
    def dm_host_neighbourhood(self) -> DataFrame:
        return marts.dm_host_neighbourhood(self.host_panel())

    @cached_property
    def dm_property_type(self) -> DataFrame:
        return marts.dm_property_type(self.property_panel())


#: Tables in waves: those of one wave depend on earlier ones only.
WAVES = [
    ["airbnb", "lga_code", "lga_suburb", "census_g01", "census_g02"],
    ["silver_airbnb_clean", "silver_lga_code_clean", "silver_lga_suburb_clean", "silver_census_g01_clean", "silver_census_g02_clean"],
    ["silver_host", "silver_listing", "silver_listing_for_fact", "silver_lga", "ref_census_g01", "ref_census_g02"],
    ["host_snapshot", "property_snapshot", "dim_date", "dim_suburb", "ref_lga"],
    ["dim_host", "dim_property", "fact_listings"],
]
TABLES = [name for wave in WAVES for name in wave]
VIEWS = ["silver_host_for_snapshot", "silver_property_for_snapshot",
         "dm_listing_neighbourhood", "dm_host_neighbourhood", "dm_property_type"]
