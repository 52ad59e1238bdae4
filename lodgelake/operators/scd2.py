"""Type-2 slowly changing dimensions (§2.13) and month-window versions.

Snapshot semantics follow dbt's documented ``timestamp`` strategy: a key gets a
new version whenever an incoming ``updated_at`` is later than its open version's
``dbt_valid_from`` (whether or not an attribute changed); the open version is
closed at the new ``updated_at``; older or equal rows are ignored; keys that stop
appearing stay open.

* ``scd2_replay``: the snapshot as if every load had arrived in order, computed in
  one pass -- one version per distinct (key, updated_at) and
  ``dbt_valid_to = lead(updated_at)``.  Deterministic; accepts loads in any order.
* ``scd2_merge``: one incremental load against an existing snapshot.  Only the
  open versions meet the incoming rows (a join on the key, ``scd2_advance``); closed versions
  stay as they are, and the monthly load does not even read them (``plans.incremental``).

Per-key windows hold one row per key and month, so a hot key costs one row per
month, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions.dates import month_start
from lodgelake.functions.keys import scd_id
from lodgelake.operators.dedup import asc, desc, top_per_group

SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _versions(rows: DataFrame, key: str, updated_at: str, columns: Sequence[str]) -> DataFrame:
    return rows.select(*columns,
                       scd_id(key, updated_at).alias("dbt_scd_id"),
                       F.col(updated_at).alias("dbt_updated_at"),
                       F.col(updated_at).alias("dbt_valid_from"))


def _one_per_timestamp(rows: DataFrame, key: str, updated_at: str, columns: Sequence[str]) -> DataFrame:
    others = [c for c in columns if c not in (key, updated_at)]
    return top_per_group(rows, [key, updated_at], [asc(c) for c in others])


def scd2_replay(feed: DataFrame, key: str, updated_at: str, columns: Sequence[str]) -> DataFrame:
    """Full snapshot from every load at once (in-order semantics).

    The feed is hash-partitioned on the key once: that partitioning satisfies the
    per-(key, updated_at) de-duplication, the per-key ``lead`` and, when the
    versions are consumed in the same plan, ``month_versions`` -- one shuffle for
    the chain.  The feed holds one row per key and month, so even a hot key adds
    only its months to a partition.
    """
    rows = _one_per_timestamp(feed.where(F.col(updated_at).isNotNull()).repartition(key),
                              key, updated_at, columns)
    w = Window.partitionBy(key).orderBy(F.col("dbt_valid_from").asc())
    return _versions(rows, key, updated_at, columns).withColumn(
        "dbt_valid_to", F.lead("dbt_valid_from").over(w))


def scd2_advance(open_: DataFrame, incoming: DataFrame, key: str, updated_at: str,
                 columns: Sequence[str]) -> DataFrame:
    """Open versions after one load: those it closed, and those that are open now.

    The open versions meet nothing but joins on the key, and no union of them is sorted or partitioned again:
    where both sides are tables bucketed by the key, the plan has no exchange at all.
    """
    out_cols = list(columns) + SCD_COLUMNS
    open_from = open_.groupBy(key).agg(F.max("dbt_valid_from").alias("_open_from"))
    fresh = (incoming.where(F.col(updated_at).isNotNull())
             .join(open_from, key, "left")
             .where(F.col("_open_from").isNull() | (F.col(updated_at) > F.col("_open_from")))
             .drop("_open_from"))
    w = Window.partitionBy(key).orderBy(F.col("dbt_valid_from").asc())
    fresh = (_versions(_one_per_timestamp(fresh, key, updated_at, columns), key, updated_at, columns)
             .withColumn("dbt_valid_to", F.lead("dbt_valid_from").over(w)))
    first_new = fresh.groupBy(key).agg(F.min("dbt_valid_from").alias("_closed_at"))
    kept = open_.join(first_new, key, "left").withColumn("dbt_valid_to", F.col("_closed_at"))
    return kept.select(*out_cols).unionByName(fresh.select(*out_cols))


def scd2_merge(current: DataFrame, incoming: DataFrame, key: str, updated_at: str,
               columns: Sequence[str]) -> DataFrame:
    """Apply one load to a snapshot; returns the complete new snapshot.

    Re-applying the same load is a no-op; rows not newer than a key's open version
    (late months) are dropped, as dbt does.

    ``current`` is the previous run's written snapshot (or a checkpoint of it).
    Passing a lazily computed, key-partitioned plan instead can make Spark run the
    unions below partition-wise over shuffles that AQE coalesced differently
    (``spark.sql.unionOutputPartitioning``), which fails at execution.
    """
    current = current.select(*columns, *SCD_COLUMNS)
    closed = current.where(F.col("dbt_valid_to").isNotNull())
    open_ = current.where(F.col("dbt_valid_to").isNull())
    return closed.unionByName(scd2_advance(open_, incoming, key, updated_at, columns))


def month_versions(snapshot: DataFrame, key: str, attributes: Sequence[str],
                   order: Sequence = ()) -> DataFrame:
    """One version per (key, calendar month of ``dbt_valid_from``).

    ``record_start_date`` is the month's first day and ``record_end_date`` the next
    month's, both ``timestamp``.  When several versions fall in one month the first
    under ``order`` wins, then the latest ``dbt_valid_from``, then the attributes.
    """
    s = snapshot.select(key, *attributes, F.col("dbt_valid_from").cast("date").alias("_snap"))
    start = month_start("_snap")
    s = s.select(key, *attributes, "_snap",
                 start.cast("timestamp_ntz").alias("record_start_date"),
                 F.add_months(start, 1).cast("timestamp_ntz").alias("record_end_date"))
    tie = list(order) + [desc("_snap")] + [asc(a) for a in attributes]
    return top_per_group(s, [key, "record_start_date"], tie).drop("_snap")
