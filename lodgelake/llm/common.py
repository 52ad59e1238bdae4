"""Helpers shared by the operators: scratch tables on shared storage and value rules."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.session import ensure_checkpoint_dir

#: Words of the mixing, fingerprint and language-model operators: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (visible to all executors).

    Every call gets a new one, so a retried job never reads or overwrites an older attempt.
    ``release`` removes them all once the results have been written elsewhere.
    """
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back: lineage ends here, so a lost executor
    costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete the scratch tables of this session (after its results were written)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/llm")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or plain path (a mounted shared folder); None for other stores."""
    if re.match(r"file:/", uri):
        return "/" + re.sub(r"^file:/+", "", uri)
    return uri if uri.startswith("/") else None


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_of(column: str) -> Column:
    """A never-null join key for a nullable string: null and every text stay apart."""
    c = F.col(column).cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), c))


#: A key with more than this part of all rows is hot; there are fewer such keys than 1 / HOT.
HOT = 1 / 2000


def join_counted(rows: DataFrame, small: DataFrame, keys: list[str], counted: str, total: int) -> DataFrame:
    """``rows`` joined with ``small``, one row per key that says in ``counted`` how many of the ``total`` rows have it.

    Rows of hot keys stay where they are and meet the broadcast rows of those keys, fewer than 1 / HOT; all others are
    shuffled by key, so no task gets more than its share of one key.
    """
    limit = F.lit(max(1, int(total * HOT)))
    hot = F.broadcast(small.where(F.col(counted) > limit))
    rest = small.where(F.col(counted) <= limit)
    others = rows.join(F.broadcast(small.where(F.col(counted) > limit).select(*keys)), keys, "left_anti")
    return rows.join(hot, keys).unionByName(others.join(rest, keys))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
