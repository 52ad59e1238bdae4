"""Priority lookup of a host neighbourhood to its LGA.

The reference left-joins the reference table three times: by suburb, then by LGA
name only where the suburb missed, then an override list, and coalesces the three.
All three lookups depend only on the key, so the priority is resolved once on the
small side into a single (key -> code, name) table and the facts take one left
join, whose strategy the planner and AQE choose from measured sizes.  Multiplicities are kept: a suburb in two LGAs yields two
rows, as in the reference.

``literal=False`` (default) reduces the by-name lookup to distinct (code, name),
so a neighbourhood equal to an LGA name maps to that LGA once.  ``literal=True``
keeps the reference's fan-out, where the name matches every suburb row of the LGA
and the host's revenue is counted once per suburb.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


# The reference's inline override relation.
OVERRIDES = [("unknown", None, "Unknown"), ("overseas", None, "Overseas")]
OVERRIDE_SCHEMA = T.StructType([
    T.StructField("key_norm", T.StringType(), False),
    T.StructField("lga_code", T.StringType(), True),
    T.StructField("lga_name", T.StringType(), True),
])


def overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OVERRIDES, OVERRIDE_SCHEMA)


def lga_lookup_table(ref_lga: DataFrame, override_rows: DataFrame, literal: bool = False) -> DataFrame:
    """(lookup_key, lga_code, lga_name) with the suburb > name > override priority applied."""
    by_suburb = ref_lga.select(F.lower(F.trim("lga_suburb")).alias("lookup_key"), "lga_code", "lga_name")
    by_name = ref_lga.select(F.lower(F.trim("lga_name")).alias("lookup_key"), "lga_code", "lga_name")
    if not literal:
        by_name = by_name.distinct()
    by_override = override_rows.select(F.col("key_norm").alias("lookup_key"), "lga_code", "lga_name")
    answers = [df.withColumn("_rank", F.lit(rank)) for rank, df in enumerate((by_suburb, by_name, by_override))]
    every = answers[0].unionByName(answers[1]).unionByName(answers[2]).where("lookup_key is not null")
    # a key keeps the answers of the first kind that knows it: one window, one shuffle of the lookup rows
    best = F.min("_rank").over(Window.partitionBy("lookup_key"))
    return every.withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


def priority_lookup(df: DataFrame, key_col: str, table: DataFrame,
                    code_col: str = "host_neighbourhood_lga_code",
                    name_col: str = "host_neighbourhood_lga") -> DataFrame:
    """Left-join ``df`` to a resolved lookup table on ``key_col`` (null keys match nothing)."""
    t = table.select("lookup_key", F.col("lga_code").cast("string").alias(code_col),
                     F.col("lga_name").alias(name_col))
    return df.join(t, df[key_col] == t["lookup_key"], "left").drop("lookup_key")
