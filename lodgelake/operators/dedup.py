"""Top-1 per group (W1-W3, D2) and the warehouse's null ordering.

``row_number() = 1`` over a window lets Spark insert a partial ``WindowGroupLimit``
below the shuffle, so each map task forwards at most one row per group: a hot key
(one listing with a third of all rows) is cut down before it is shuffled.

The reference orders by the date alone, so ties are arbitrary there; every
operator here takes a ``tie_break`` list so that the chosen row is deterministic
(required for any value check).  Null order follows the warehouse: ascending puts
nulls last, descending puts them first (Spark's own default is the reverse).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.functions._col import col


def asc(c) -> Column:
    return col(c).asc_nulls_last()


def desc(c) -> Column:
    return col(c).desc_nulls_first()


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  rank_col: str = "_rn") -> DataFrame:
    """Keep the first row of each ``keys`` group under ``order`` (DISTINCT ON)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) == 1).drop(rank_col)


def latest_per_group(df: DataFrame, keys: Sequence[str], ts: str,
                     tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest row per group: ``order by ts desc`` then ``tie_break`` descending."""
    return top_per_group(df, keys, [desc(ts)] + [desc(c) for c in tie_break])


def earliest_per_group(df: DataFrame, keys: Sequence[str], ts: str,
                       tie_break: Sequence[str] = ()) -> DataFrame:
    """Earliest row per group: ``order by ts`` then ``tie_break`` ascending."""
    return top_per_group(df, keys, [asc(ts)] + [asc(c) for c in tie_break])
