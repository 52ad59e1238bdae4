"""Contiguous shards of near-equal bytes from global prefix sums.

Documents are put in ascending key order by a range exchange of (key, size, checksum) rows -
texts are measured where they are read and never travel.  Each range partition contributes one
total; the running sum of those totals gives every partition its global byte offset, and the
byte axis is cut at equal targets: a document goes to the shard that its middle byte falls in,
so a shard differs from the target by at most half a document at either end.

Defined cases: a null text has no bytes (size 1, checksum 0), a null id sorts first, repeated
rows are separate documents, an empty table gives no rows, a document larger than a whole
target may leave shards empty.  Input columns other than the id, the text and ``keep`` are not
read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgelake.llm.common import shuffle_parts
from lodgelake.session import ensure_checkpoint_dir


def shard_by_bytes(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, ``keep``, size, text_crc32, shard and slot (gapless within a shard) per document.

    Driver state: one (rows, bytes) pair per range partition and one count per shard.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    text = F.col(text_col).cast("string")
    sized = docs.select(
        F.col(id_col).alias("doc_id"), *keep,
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"))
    order = [F.col("doc_id").asc_nulls_first(), "text_crc32", "size"]
    # the order must be one and the same in every pass, so it is materialised once
    ordered = (sized.repartitionByRange(shuffle_parts(spark), *order)
               .sortWithinPartitions(*order).checkpoint())
    totals = {r["pid"]: (r["rows"], r["bytes"]) for r in ordered.groupBy(F.spark_partition_id().alias("pid"))
              .agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).collect()}
    starts, row, byte = {}, 0, 0
    for pid in sorted(totals):
        starts[pid] = (row, byte)
        row, byte = row + totals[pid][0], byte + totals[pid][1]
    total = max(byte, 1)

    def shard_of(before: np.ndarray, size: np.ndarray) -> np.ndarray:
        # floor(middle * n / total) in whole numbers: exact up to 2**63 / (2 n) bytes, then via Python ints
        if total < 2 ** 62 // n_shards:
            return (2 * before + size) * n_shards // (2 * total)
        return np.array([(2 * int(b) + int(s)) * n_shards // (2 * total) for b, s in zip(before, size)], dtype=np.int64)

    schema = T.StructType([*ordered.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("_row", T.LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at_row, at_byte = starts.get(TaskContext.get().partitionId(), (0, 0))
        for pdf in batches:
            size = pdf["size"].to_numpy(np.int64)
            before = at_byte + np.cumsum(size) - size
            pdf["shard"] = shard_of(before, size).astype(np.int32)
            pdf["_row"] = at_row + np.arange(len(pdf), dtype=np.int64)
            at_row, at_byte = at_row + len(pdf), at_byte + int(size.sum())
            yield pdf

    placed = ordered.mapInPandas(place, schema)
    counts = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    first, base = 0, []
    for k in range(n_shards):
        base.append(first)
        first += counts.get(k, 0)
    slot = F.col("_row") - F.element_at(F.array(*[F.lit(b).cast("long") for b in base]), F.col("shard") + 1)
    return placed.withColumn("slot", slot).drop("_row")
