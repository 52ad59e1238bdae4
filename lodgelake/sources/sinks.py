"""Sinks (S7-S10): catalog tables written by Spark's own committer.

A table enters the catalog only after its files were committed, so ``tableExists`` is what tells a finished
write from a failed one, and every attempt has a folder of its own.  Layers are databases
(``<database>_bronze``, ``_silver``, ``_snapshots``, ``_gold``); a run's tables lie in ``<layer>__<run>`` and the
names without a run are views over the published run's tables, replaced one by one after all of them are written.

Metrics come from the write itself: ``DataFrame.observe`` counts rows and violations while they are written.

The root must be shared storage on a cluster, and the session's catalog a lasting one (a metastore) if other
sessions are to see the tables.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LAYER = {
    "airbnb": "bronze", "lga_code": "bronze", "lga_suburb": "bronze", "census_g01": "bronze",
    "census_g02": "bronze",
    "host_snapshot": "snapshots", "property_snapshot": "snapshots",
}
LAYERS = ("bronze", "silver", "snapshots", "gold")


def layer_of(name: str) -> str:
    if name in LAYER:
        return LAYER[name]
    if name.startswith("silver_"):
        return "silver"
    return "gold"


def checked_name(name: str) -> str:
    """``name`` if it can be part of a table's or database's name."""
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"use letters, digits and underscores only: {name!r}")
    return name


def create_database(spark: SparkSession, name: str, location: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {checked_name(name)} LOCATION '{location}'")
    return name


def laid_out(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value brought together (sizes balanced by AQE), so files number about values x size
    and not tasks x values, and sorted inside a file."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df


def write_table(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
                max_records_per_file: int | None = None, metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """Write ``df`` as the new catalog table ``table`` under a fresh folder of ``path``.

    Returns the written table and the metrics (name -> aggregate) observed while it was written.
    """
    columns = [c for c in df.columns if not c.startswith("_check_")]
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in (metrics or {}).items()]).select(*columns)
    writer = laid_out(observed, partition_by, sort_by).write.format("parquet").option("compression", "zstd").option("path", f"{path}/{uuid.uuid4().hex[:12]}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    writer.saveAsTable(table)
    return df.sparkSession.table(table).select(*columns), seen.get


def overwrite_partitions(df: DataFrame, table: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> None:
    """Replace the partitions of ``table`` that ``df`` has rows for, and no others."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        laid_out(df.select(*columns), partition_by, sort_by).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def publish_views(spark: SparkSession, database: str, root: str, tables: dict[str, str]) -> None:
    """Name the tables of a run: ``<database>_<layer>.<name>`` becomes a view of ``tables[name]``."""
    for layer in {layer_of(name) for name in tables}:
        create_database(spark, f"{database}_{layer}", f"{root}/published/{layer}")
    for name, table in tables.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}_{layer_of(name)}.{name} AS SELECT * FROM {table}")
