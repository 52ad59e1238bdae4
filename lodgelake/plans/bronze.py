"""Bronze layer (R1-R5): the sources copied as they arrive (``select *``)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def copy(source: DataFrame) -> DataFrame:
    return source.select("*")
