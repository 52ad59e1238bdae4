"""Stored marts and their monthly refresh.

``store_marts`` writes the panels and marts of a build as catalog tables partitioned by ``month_start``.  After
``land_month``, ``refresh_months`` recomputes what the landed months change and overwrites those partitions only:

* facts, host versions and property versions of the landed months, from the landed rows of these months (cleaning,
  the latest row of a listing's month and the version of a key's month are all month-local);
* the panels of these months, from the stored tables: both sides of every version join list only their files.  Facts
  outside the calendar meet in the null month, so a landed month that is not wholly inside the calendar also
  recomputes the null month, from all such months;
* the marts of these months and, because of the change against the previous present month (W4-W7), of each
  month that is the next one of some group, before or after the load.

Every step overwrites whole partitions with results of tables it does not write, so a refresh that failed is
run again from the start.  A month that has landed rows but loses all of a table's rows keeps its old partition there.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodgelake.operators.dedup import asc
from lodgelake.plans import marts
from lodgelake.plans.build import LAYOUT, MAX_RECORDS_PER_FILE, run_table
from lodgelake.plans.model import RentalModel
from lodgelake.sources.sinks import layer_of, overwrite_partitions, publish_views, write_table

#: panel -> (its groups apart from the month, mart)
PANELS = {
    "listing_panel": (["suburb_id"], "dm_listing_neighbourhood"),
    "host_panel": (marts.HOST_MART_KEYS[1:], "dm_host_neighbourhood"),
    "property_panel": (marts.PROPERTY_GROUP, "dm_property_type"),
}


class Stored:
    """The tables of a run, as the relations that the panels and marts are made of."""

    def __init__(self, model: RentalModel, database: str, root: str, run_id: str):
        self.model, self.database, self.root, self.run_id = model, database, root.rstrip("/"), run_id
        self.spark: SparkSession = model.spark

    def name(self, table: str) -> str:
        return run_table(self.database, self.run_id, table)

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def panel(self, name: str, months: DataFrame | None = None) -> DataFrame:
        fact, hosts = self.table("fact_listings"), self.table("dim_host")
        if name == "listing_panel":
            return marts.listing_panel(fact, hosts, months)
        if name == "host_panel":
            return marts.host_panel(fact, hosts, self.table("ref_lga"), self.model.lga_overrides, self.model.literal, months)
        return marts.property_panel(fact, self.table("dim_property"), hosts, months)

    def mart(self, name: str) -> DataFrame:
        """A mart from its stored panel: one row per group and month."""
        panel = self.table(name)
        if name == "listing_panel":
            return marts.dm_listing_neighbourhood(panel, self.table("dim_suburb"))
        return marts.dm_host_neighbourhood(panel) if name == "host_panel" else marts.dm_property_type(panel)


def store_marts(model: RentalModel, database: str, root: str, run_id: str) -> Stored:
    """Write panels and marts of a build by month and publish the marts as views of the gold layer."""
    stored = Stored(model, database, root, run_id)
    for name, (_, mart) in PANELS.items():
        for table, rows in ((name, lambda: stored.panel(name)), (mart, lambda: stored.mart(name))):
            if not stored.spark.catalog.tableExists(stored.name(table)):
                write_table(rows(), stored.name(table), f"{stored.root}/{run_id}/{layer_of(table)}/{table}", ["month_start"], [], MAX_RECORDS_PER_FILE)
    publish_views(stored.spark, database, stored.root, {mart: stored.name(mart) for _, mart in PANELS.values()})
    return stored


def _dates(df: DataFrame) -> set[dt.date | None]:
    """Distinct months: one row each."""
    return {r[0] for r in df.distinct().collect()}


def _outside(months: DataFrame, bounds: Sequence[str] | None) -> DataFrame:
    """Months that are not wholly inside the calendar."""
    if bounds is None:
        return months.where(F.lit(False))
    lo, hi = (F.lit(d).cast("date") for d in bounds)
    return months.where((F.col("month") < lo) | (F.last_day("month") > hi))


def _next_months(panel: DataFrame, group: Sequence[str], months: list[dt.date | None]) -> set[dt.date | None]:
    """Months whose previous present month, in some group, is one of ``months``."""
    before = F.lag(F.struct("month_start")).over(Window.partitionBy(*group).orderBy(asc("month_start")))
    known = [m for m in months if m is not None]
    return _dates(panel.select("month_start", before.alias("before")).where(F.col("before.month_start").isin(known)).select("month_start"))


def _in(column: str, months: set[dt.date | None]):
    return F.col(column).isin([m for m in months if m is not None]) | (F.col(column).isNull() if None in months else F.lit(False))


def refresh_months(stored: Stored, landed: dict[str, DataFrame], bounds: tuple[str, str] | None) -> dict[str, list]:
    """Bring the stored tables up to date with landed months; returns the months that each table got anew.

    ``landed`` are sources whose ``airbnb_raw`` holds all rows of the landed months and no others; ``bounds`` is
    the calendar of the build (None: it covers the data).
    """
    spark = stored.spark
    month = RentalModel(spark, landed, calendar_bounds=bounds or "data", literal=stored.model.literal)
    # the stored tables of the landed months: their own source rows only, so nothing that is overwritten is read
    for name, rows in (("fact_listings", month.listing_facts), ("dim_host", month.host_versions), ("dim_property", month.property_versions)):
        overwrite_partitions(rows, stored.name(name), *LAYOUT[name])
    new_names = month.dim_suburb.join(stored.table("dim_suburb").select("suburb_id"), "suburb_id", "left_anti")
    new_names.select(*stored.table("dim_suburb").columns).write.insertInto(stored.name("dim_suburb"))

    months = landed["airbnb_raw"].select(F.col("source_month").alias("month")).distinct()
    changed = _dates(months)
    todo = months
    if not _outside(months, bounds).isEmpty():
        changed.add(None)
        todo = months.union(_outside(stored.table("fact_listings").select("month").distinct(), bounds)).distinct()
    done: dict[str, list] = {}
    for name, (group, mart) in PANELS.items():
        affected = changed | _next_months(stored.table(name), group, list(changed))
        # of months that only feed the null month, the panel's own rows are whole as well
        overwrite_partitions(stored.panel(name, todo), stored.name(name), ["month_start"])
        affected |= _next_months(stored.table(name), group, list(changed))
        overwrite_partitions(stored.mart(name).where(_in("month_start", affected)), stored.name(mart), ["month_start"])
        done[name], done[mart] = sorted(changed, key=str), sorted(affected, key=str)
    return done
