"""Hashed keys.

``surrogate_key`` follows the public definition of the dbt_utils
``generate_surrogate_key`` macro: each value cast to text, nulls replaced by a
sentinel, joined with '-', then md5.  ``scd_id`` follows dbt's documented snapshot
id for the timestamp strategy: md5 of ``key || '|' || updated_at``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodgelake.functions._col import col

# Fixed values that must equal the published macro's.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"
SCD_ID_SEPARATOR = "|"


def surrogate_key(*cols) -> Column:
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def scd_id(key, updated_at) -> Column:
    return F.md5(F.concat(
        F.coalesce(col(key).cast("string"), F.lit("")),
        F.lit(SCD_ID_SEPARATOR),
        F.coalesce(col(updated_at).cast("string"), F.lit("")),
    ))
