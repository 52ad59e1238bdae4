"""Readers for the raw sources (S1) with explicit schemas.

Real monthly scrapes land as CSV or parquet; either way the schema is given, so
nothing is inferred and a scan prunes to the columns a plan uses.  Parquet drops
written by ``sinks.write_table`` are partitioned by ``source_month`` so a
one-month load prunes files by partition instead of reading every month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodgelake.sources.schemas import SOURCES


def read_source(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                **options) -> DataFrame:
    schema = SOURCES[name]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true").option("mode", "FAILFAST")
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.format(fmt).load(path).select(*schema.fieldNames())


def read_sources(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """All five sources from ``root/<name>`` folders."""
    return {name: read_source(spark, name, f"{root.rstrip('/')}/{name}", fmt) for name in SOURCES}
