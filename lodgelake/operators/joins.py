"""Point-in-time join of facts to month-window versions.

The reference joins on ``key = key and at >= start and at < coalesce(end, 9999-12-31)``.
Spark would plan that as a hash/sort-merge join on the key alone with the range as a
residual, so every fact row of a key meets every version of that key -- a
key × months blow-up, worst on a hot key.  Versions built by
``scd2.month_versions`` always cover exactly one calendar month, so the month
of ``at`` is added as a second equi-key: each fact row meets at most the one
version of its month, the shuffle spreads a hot key over its months, and AQE can
split a still-skewed (key, month) partition.  Facts without a key can match nothing;
they are spread over the partitions by their other join columns instead of meeting in
one per month.  The original range predicate stays as a residual, so the result equals
the range join for such versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.functions.dates import month_start

OPEN_END = "9999-12-31"
NULL_SPREAD = 1024  # partitions that facts without a key are dealt over, at most


def month_version_join(facts: DataFrame, versions: DataFrame, key: str, at: str,
                       attributes: Sequence[str], version_key: str | None = None,
                       start: str = "record_start_date", end: str = "record_end_date",
                       how: str = "left", null_keys: bool = True) -> DataFrame:
    """Attach ``attributes`` of the version of ``facts[key]`` valid at ``facts[at]``.

    Where both sides have a ``month`` column (the partition column of the stored tables), it is the join's
    month, so restricting one side's months prunes the other side's files too; else the month is that
    of ``at`` and of the version's start.  ``null_keys=False`` says that no fact lacks a key: facts that are already
    partitioned by key and month then stay where they are, and what is grouped by both after the join does, too.
    """
    version_key = version_key or key
    stored = "month" in facts.columns and "month" in versions.columns
    v = versions.select(F.col(version_key).alias("_pit_key"), F.col(start).alias("_pit_start"),
                        F.col(end).alias("_pit_end"), *attributes,
                        (F.col("month") if stored else F.col(start).cast("date")).alias("_pit_of"))
    spread = (-1 - F.pmod(F.xxhash64(*[c for c in facts.columns if c != key]), F.lit(NULL_SPREAD))).cast("bigint")
    f = (facts.withColumn("_pit_month", F.col("month") if stored else month_start(at))
         .withColumn("_pit_by", F.coalesce(F.col(key).cast("bigint"), spread) if null_keys else F.col(key)))
    at_ts = F.col(at).cast("timestamp_ntz")
    cond = ((F.col("_pit_by") == F.col("_pit_key"))
            & (F.col("_pit_month") == F.col("_pit_of"))
            & (at_ts >= F.col("_pit_start"))
            & (at_ts < F.coalesce(F.col("_pit_end"), F.lit(OPEN_END).cast("timestamp_ntz"))))
    if null_keys:
        return f.join(v, cond & F.col(key).isNotNull(), how).select(*facts.columns, *attributes)
    # the join's own columns take the place of the facts': one column less moves, and the partitioning is known above the join
    own = {key: F.col("_pit_by").alias(key), **({"month": F.col("_pit_month").alias("month")} if stored else {})}
    return f.join(v, cond, how).select(*[own.get(c, F.col(c)) for c in facts.columns], *attributes)
