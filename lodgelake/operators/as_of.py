"""Point-in-time join to versions of any interval (F11, J7-J10 without the one-month windows).

``key = key and at >= start and at < end`` with open ends would be planned as an equi-join on the key with the
range as a residual: every fact of a key meets every version of it.  Here nothing is compared pairwise:

1. Time is cut into ranges (``unit``).  The (key, range) pairs that facts have are reduced to one mark each
   before they move, so a hot key costs one row per range.
2. Marks and version starts of a key, ordered by time, tell which version is under way when a range
   begins (``last_value ignore nulls``).
3. Facts, the version starts of their range and the version under way are ordered by time inside (key, range): the
   last start before a fact is its version, if that has not ended by then.

So a hot key is spread over its ranges, and ``salts`` spreads the facts of one (key, range) further, for
the price of that many copies of the range's few version starts.

Versions of a key must not overlap (at most one holds at any time); of versions with one start the one that ends
last counts.  Facts without a key or time match nothing and are kept.  Columns may be dates or timestamps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, at: str, attributes: Sequence[str], start: str = "dbt_valid_from",
               end: str = "dbt_valid_to", version_key: str | None = None, unit: str = "quarter", salts: int = 1) -> DataFrame:
    """``facts`` with ``attributes`` of the version of ``facts[key]`` that holds at ``facts[at]`` (null if none does)."""
    names = facts.columns
    when = F.col(at).cast("timestamp_ntz")
    packed = facts.select(F.struct(*names).alias("_fact"), F.col(key).alias("_key"), when.alias("_time"),
                          F.trunc(F.col(at).cast("date"), unit).alias("_range"),
                          F.pmod(F.xxhash64(*names), F.lit(salts)).cast("int").alias("_salt"))
    timed = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    version = F.struct(F.col(end).cast("timestamp_ntz").alias("_end"), *[F.col(a).alias(f"_a_{a}") for a in attributes])
    begins = (versions.where(F.col(version_key or key).isNotNull() & F.col(start).isNotNull())
              .select(F.col(version_key or key).alias("_key"), F.col(start).cast("timestamp_ntz").alias("_time"),
                      F.trunc(F.col(start).cast("date"), unit).alias("_range"), version.alias("_version")))
    # of versions that start together, the one that ends last (an open one before all)
    latest_end = [F.col("_version._end").isNull().cast("int"), F.col("_version._end")]

    marks = packed.where(timed).select("_key", "_range", "_salt").distinct()
    at_mark = marks.select("_key", "_range").distinct().select(
        "_key", F.col("_range").cast("timestamp_ntz").alias("_time"), "_range", F.lit(None).cast(begins.schema["_version"].dataType).alias("_version"), F.lit(1).alias("_mark"))
    events = at_mark.unionByName(begins.withColumn("_mark", F.lit(0)))
    # a start at the very beginning of a range is an event of the range itself, so marks come before it
    so_far = Window.partitionBy("_key").orderBy("_time", F.col("_mark").desc(), *latest_end)
    under_way = (events.withColumn("_version", F.last("_version", ignorenulls=True).over(so_far))
                 .where((F.col("_mark") == 1) & F.col("_version").isNotNull()).select("_key", "_time", "_range", "_version"))

    # at one moment: the version under way, then starts, then facts
    inside = begins.withColumn("_step", F.lit(1)).unionByName(under_way.withColumn("_step", F.lit(0))).join(marks, ["_key", "_range"]).select(
        "_key", "_time", "_range", "_salt", "_version", F.lit(None).cast(packed.schema["_fact"].dataType).alias("_fact"), F.col("_step"))
    asked = packed.where(timed).select("_key", "_time", "_range", "_salt", F.lit(None).cast(begins.schema["_version"].dataType).alias("_version"), "_fact", F.lit(2).alias("_step"))
    order = Window.partitionBy("_key", "_range", "_salt").orderBy("_time", "_step", *latest_end)
    found = (asked.unionByName(inside).withColumn("_version", F.last("_version", ignorenulls=True).over(order)).where("_step = 2"))
    holds = F.col("_version").isNotNull() & (F.col("_version._end").isNull() | (F.col("_time") < F.col("_version._end")))
    out = [F.col("_fact").getField(c).alias(c) for c in names]
    matched = found.select(*out, *[F.when(holds, F.col(f"_version._a_{a}")).alias(a) for a in attributes])
    types = {f.name: f.dataType for f in versions.schema}
    rest = packed.where(~timed).select(*out, *[F.lit(None).cast(types[a]).alias(a) for a in attributes])
    return matched.unionByName(rest)
