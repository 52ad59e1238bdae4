"""Entry point B: one monthly load.

* ``land_month`` puts one drop of a month's raw scrape into bronze.  The table is partitioned by
  month and drop, and a drop replaces only itself: landing it again changes nothing, and further
  drops of the same month are added.  ``read_landed`` gives the rows of all drops.
* ``merge_month_snapshots`` applies a load to the snapshots of a database.  ``host_snapshot`` and
  ``property_snapshot`` are views there.  Their versions lie in one catalog table each, bucketed and sorted by
  the key and partitioned by the attempt that wrote them and by open or closed.  A load reduces its rows to a
  feed, stages that in the same buckets (the only shuffle), and joins it with the open versions of the published
  run where they lie; it appends partitions of its own: the versions that it closes and those that are open
  now.  Earlier closed partitions are neither read nor written.

The one view ``published`` names the runs and the attempt of each, and so the state: both snapshots read the open
partition of its newest attempt and the closed ones of all.  Replacing it is the last step of a load, so a load that fails
before leaves everything as it was, and its retry is another attempt.  A run id that is published is not applied twice.  Loads of one database must follow one
another (as snapshot runs do); a load that finds a newer run than it started from refuses to publish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.operators.scd2 import SCD_COLUMNS, scd2_advance, scd2_merge, scd2_replay
from lodgelake.plans.model import RentalModel
from lodgelake.plans.silver import HOST_FEED_COLUMNS
from lodgelake.plans.star import PROPERTY_SNAPSHOT_COLUMNS
from lodgelake.sources.schemas import AIRBNB_RAW
from lodgelake.sources.sinks import checked_name, create_database

#: snapshot -> (key, columns, the model's feed)
SNAPSHOTS = {
    "host_snapshot": ("host_id", HOST_FEED_COLUMNS, "silver_host_for_snapshot"),
    "property_snapshot": ("listing_id", PROPERTY_SNAPSHOT_COLUMNS, "silver_property_for_snapshot"),
}
UPDATED_AT = "scraped_date"


def land_month(raw: DataFrame, bronze_path: str, drop: str) -> None:
    """Land one drop of raw rows; ``drop`` names it among its months' drops."""
    (raw.withColumn("drop", F.lit(drop)).hint("rebalance", "source_month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("source_month", "drop").parquet(bronze_path))


def read_landed(spark: SparkSession, bronze_path: str) -> DataFrame:
    """The raw rows of all landed drops."""
    return spark.read.schema(AIRBNB_RAW).parquet(bronze_path).select(*AIRBNB_RAW.fieldNames())


def published_runs(spark: SparkSession, database: str) -> list[tuple[str, str]]:
    """(run id, attempt) of the runs that the database's state consists of, oldest first ([] before the first)."""
    if not spark.catalog.tableExists(f"{checked_name(database)}.published"):
        return []
    return [(r["run_id"], r["attempt"]) for r in spark.table(f"{database}.published").orderBy("run_no").collect()]  # one row per load


def publish(spark: SparkSession, database: str, runs: list[tuple[str, str]], after: list[tuple[str, str]]) -> None:
    """Make ``runs`` the state, if it still is ``after``."""
    if published_runs(spark, database) != after:
        raise RuntimeError(f"another run was published after {after[-1:]}, which run {runs[-1][0]!r} started from")
    rows = ", ".join(f"({n}, '{checked_name(run)}', '{checked_name(attempt)}')" for n, (run, attempt) in enumerate(runs, 1))
    spark.sql(f"CREATE OR REPLACE VIEW {database}.published AS SELECT * FROM VALUES {rows} AS runs(run_no, run_id, attempt)")


def open_versions(spark: SparkSession, database: str, name: str, attempt: str) -> DataFrame:
    """The open versions that an attempt left, where they lie in buckets."""
    _, columns, _ = SNAPSHOTS[name]
    return spark.table(f"{database}.{name}_versions").where(f"attempt = '{attempt}' and is_open").select(*columns, *SCD_COLUMNS)


def staged_feed(spark: SparkSession, database: str, name: str, attempt: str) -> DataFrame:
    """The feed of an attempt, in the same buckets."""
    _, columns, _ = SNAPSHOTS[name]
    return spark.table(f"{database}.{name}_feed").where(f"attempt = '{attempt}'").select(*columns)


def _create(spark: SparkSession, database: str, buckets: int, schemas: dict[str, DataFrame]) -> None:
    """The bucketed tables of the snapshots and their views, where they are missing."""
    if not spark.catalog.tableExists(f"{database}.published"):
        spark.sql(f"CREATE VIEW {database}.published AS SELECT 0 AS run_no, '' AS run_id, '' AS attempt WHERE false")
    for name, rows in schemas.items():
        key, columns, _ = SNAPSHOTS[name]
        types = {f.name: f.dataType.simpleString() for f in rows.schema}
        fields = lambda names: ", ".join(f"{c} {types[c]}" for c in names)
        bucketed = f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name}_feed ({fields(columns)}, attempt string) "
                  f"USING parquet PARTITIONED BY (attempt) {bucketed}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name}_versions ({fields([*columns, *SCD_COLUMNS])}, attempt string, is_open boolean) "
                  f"USING parquet PARTITIONED BY (attempt, is_open) {bucketed}")
        wanted = ", ".join([*columns, *SCD_COLUMNS])
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS "
                  f"SELECT {wanted} FROM {database}.{name}_versions WHERE is_open AND attempt = (SELECT max_by(attempt, run_no) FROM {database}.published) "
                  f"UNION ALL SELECT {wanted} FROM {database}.{name}_versions WHERE NOT is_open AND attempt IN (SELECT attempt FROM {database}.published)")


def _append(rows: DataFrame, table: str, attempt: str, columns: list[str], then: str = "") -> None:
    """Add an attempt's partitions to a table."""
    partition, values = f"attempt = '{attempt}'", ", ".join(columns)
    if then:
        partition, values = f"{partition}, is_open", f"{values}, {then}"
    rows.sparkSession.sql(f"INSERT INTO {table} PARTITION ({partition}) SELECT {values} FROM {{rows}}", rows=rows)


def _buckets(spark: SparkSession, table: str) -> int:
    return next(int(r["data_type"]) for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r["col_name"] == "Num Buckets")


def merge_month_snapshots(spark: SparkSession, database: str, root: str, month_sources: dict[str, DataFrame], run_id: str | None = None,
                          literal: bool = False, buckets: int | None = None, start: dict[str, DataFrame] | None = None) -> list[str]:
    """Merge one load into the snapshots of ``database``; returns the published run ids.

    ``buckets`` counts for the first run only, which makes the tables: about an executor core's share of the keys each
    (default: the shuffle partitions).  ``start`` may give whole snapshots that the first run starts from.
    """
    run_id = checked_name(run_id or uuid.uuid4().hex[:12])
    before = published_runs(spark, database)
    if run_id in [run for run, _ in before]:
        return [run for run, _ in before]
    create_database(spark, database, f"{root.rstrip('/')}/{checked_name(database)}")
    attempt = f"{run_id}_{uuid.uuid4().hex[:12]}"
    month = RentalModel(spark, month_sources, literal=literal)
    feeds = {name: getattr(month, feed).select(*columns) for name, (_, columns, feed) in SNAPSHOTS.items()}
    if not before:
        first = {name: scd2_replay(feeds[name], key, UPDATED_AT, columns) if start is None else scd2_merge(start[name], feeds[name], key, UPDATED_AT, columns)
                 for name, (key, columns, _) in SNAPSHOTS.items()}
        _create(spark, database, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), first)
    for name, (key, columns, _) in SNAPSHOTS.items():
        width = _buckets(spark, f"{database}.{name}_feed")
        if before:
            _append(feeds[name].repartition(width, key), f"{database}.{name}_feed", attempt, columns)
            rows = scd2_advance(open_versions(spark, database, name, before[-1][1]), staged_feed(spark, database, name, attempt), key, UPDATED_AT, columns)
        else:
            rows = first[name].repartition(width, key)
        _append(rows, f"{database}.{name}_versions", attempt, [*columns, *SCD_COLUMNS], "dbt_valid_to is null")
    publish(spark, database, [*before, (run_id, attempt)], before)
    return [run for run, _ in before] + [run_id]
