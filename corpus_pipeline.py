"""A corpus pipeline of five operators: from raw documents to the shards of a training mix.

Each stage takes (spark, docs, sf_dir) and works on everything that its predecessor kept; what it returns
is written as Parquet and read again as the next stage's documents, so a stage that loses executors starts
from a table.  All stages but the last return the columns of ``documents``; the last adds the shard.

In every stage: a null text is an empty text, null or repeated ids are rows of their own, other columns pass through
whatever their names, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.llm.common import documents, written
from lodgelake.llm.decontaminate import clean_rows
from lodgelake.llm.mixing import mix
from lodgelake.llm.quality import accepted
from lodgelake.llm.sharding import shard_by_bytes
from lodgelake.llm.simhash import keep_first


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.5) go; a score of exactly 0.5 stays."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays, the first by id (nulls last) and place: 3-word shingles, at most
    3 differing bits.  Texts without words have one fingerprint and are one component."""
    return keep_first(docs, width=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in 13-word benchmark windows go; those without words stay."""
    return clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, share=20)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; sources (null last) weigh 5, 2, 1 in turn.  Equal rows draw each for
    themselves; texts without words are taken by their source's certain copies only."""
    return mix(docs, weights=(5, 2, 1), max_copies=3)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in eight contiguous shards of near-equal bytes, by id (nulls first), ties by text."""
    placed = shard_by_bytes(docs, n_shards=8, keep=("text", "lang", "source", "n_chars"))
    return placed.select("doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", F.lit("bytes").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: The classifier and the fingerprints have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
