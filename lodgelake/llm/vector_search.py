"""Exact top-k search by tiled matrix products.

Queries lie on shared storage in blocks of about a fixed number of rows; one block is searched at a time and read by
every task, so what a task holds is bounded by ``block_rows`` x dimension however many queries there are.  Each task turns its shard
of the vectors into tiles, multiplies block x tile, keeps each query's best k of the tile by partial
selection and folds that into the running lists of its shard.  The shards' lists are merged in a tree
of fixed fan-in, grouped by query, until one list per query is left.

Vectors are whole numbers floor(scale * x).  A tile whose largest possible score is below 2**53 is
multiplied in float64, which is then exact; any other tile falls back to Python's unbounded integers
(a score beyond 64 bits is reported at the limit of the type).

Defined cases: vectors that are null, hold a null or a non-finite component, or differ in length from
the query take no part with it (an empty vector scores 0 with empty ones); rows with a null id take no
part; only the query's own row is no candidate, so other rows of its id are; rows that repeat an id ask and answer
each by their own vector, rows that also repeat the vector ask once and get their results as often; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodgelake.llm.common import local_path, scratch, written

LIMIT = 2 ** 63 - 1
SCHEMA = "query long, query_id long, times long, vec_id long, score long, own int, shard int"
FIELDS = [("query", pa.int64()), ("query_id", pa.int64()), ("times", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
          ("own", pa.int32()), ("shard", pa.int32())]


def usable(vector: str) -> Column:
    """The vector is present and all its components are finite numbers."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def scaled(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(vectors.astype(np.float64) * scale)


def products(queries: np.ndarray, tile: np.ndarray) -> np.ndarray:
    """Exact integer products of two matrices of whole float64 numbers."""
    if not queries.size or not tile.size:
        return np.zeros((len(queries), len(tile)), dtype=np.int64)
    if np.abs(queries).max() * np.abs(tile).max() * queries.shape[1] < 2 ** 53:
        return (queries @ tile.T).astype(np.int64)
    as_int = np.vectorize(int, otypes=[object])
    exact = as_int(queries) @ as_int(tile).T
    return np.vectorize(lambda v: max(-LIMIT, min(LIMIT, v)), otypes=[np.int64])(exact)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k best (score descending, id ascending), by partial selection."""
    n = scores.shape[1]
    if n > k:
        # everything that scores at least the k-th value stays; only ties at that value exceed k
        kth = np.partition(scores, n - k, axis=1)[:, n - k]
        rows, cols = np.nonzero(scores >= kth[:, None])
    else:
        rows, cols = np.nonzero(np.ones_like(scores, dtype=bool))
    order = np.lexsort((ids[cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return np.stack([rows[rank < k], cols[rank < k]])


def _merge_lists(parts: DataFrame, k: int, fan_in: int) -> DataFrame:
    """Tree of top-k merges: shards meet ``fan_in`` at a time until one list per query is left."""
    n_shards = (parts.agg(F.max("shard")).first()[0] or 0) + 1
    while True:
        last = n_shards <= fan_in
        group = ["query"] if last else ["query", "shard"]
        if not last:
            parts = parts.withColumn("shard", F.floor(F.col("shard") / fan_in).cast("int"))
            n_shards = -(-n_shards // fan_in)
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("score").desc(), "vec_id", "own"))
        parts = parts.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
        if last:
            return parts.drop("shard")


def _without_own(lists: DataFrame, k: int) -> DataFrame:
    """Drop a query's own row, one of those with its id and vector, from lists of k + 1; one result per row that asks."""
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id", "own")
    nth_own = F.row_number().over(Window.partitionBy("query", "own").orderBy("vec_id"))
    left = lists.withColumn("nth_own", nth_own).where("own = 0 or nth_own > 1")
    return (left.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("_one"))
            .drop("_one"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = 8192, tile_rows: int = 2048, fan_in: int = 16) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every row of ``queries`` its k best of ``vectors``."""
    spark = vectors.sparkSession
    take = lambda df: df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(
        F.col("id").isNotNull() & usable("v"))
    rows = take(vectors)
    asked = written(take(queries).groupBy("id", "v").agg(F.count("*").alias("times")), "topk-queries")
    n_blocks = -(-asked.count() // block_rows)
    if not n_blocks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # blocks of queries lie on shared storage and are read by the tasks; the driver knows their places only
    where = scratch(spark, "topk-blocks")
    asked.repartition(n_blocks).write.parquet(where)
    blocks = sorted(spark.read.parquet(where).inputFiles())

    def search(block: str) -> DataFrame:
        def read() -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
            """length -> numbers, ids, times and vectors of the block's queries of that length."""
            path = local_path(block)
            fs, path = (pafs.LocalFileSystem(), unquote(path)) if path else pafs.FileSystem.from_uri(block)
            with fs.open_input_file(path) as f:
                table = pq.read_table(f, columns=["id", "v", "times"])
            vs = table["v"].to_pylist()
            lengths = np.array([len(v) for v in vs])
            ids, times = table["id"].to_numpy(), table["times"].to_numpy()
            out = {}
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                out[int(n)] = at, ids[at], times[at], scaled(np.array([vs[i] for i in at]).reshape(len(at), n), scale)
            return out

        def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            lists: dict[int, pd.DataFrame] = {}
            asked_of = None
            for batch in batches:
                asked_of = read() if asked_of is None else asked_of
                for at in range(0, batch.num_rows, tile_rows):
                    part = batch.slice(at, tile_rows)
                    ids, column = part.column(0).to_numpy(), part.column(1)
                    ends = column.offsets.to_numpy()
                    flat, lens = column.values.to_numpy(zero_copy_only=False), np.diff(ends)
                    for n in np.unique(lens):
                        if int(n) not in asked_of:
                            continue
                        pick = np.flatnonzero(lens == n)
                        tile = scaled(flat[ends[pick][:, None] + np.arange(n)].reshape(len(pick), n), scale)
                        number, own_ids, times, own = asked_of[int(n)]
                        scores = products(own, tile)
                        rows_, cols = best(scores, ids[pick], k + 1)
                        same = own_ids[rows_] == ids[pick][cols]
                        same[same] = (own[rows_[same]] == tile[cols[same]]).all(axis=1)
                        new = pd.DataFrame({"query": number[rows_], "query_id": own_ids[rows_], "times": times[rows_], "vec_id": ids[pick][cols],
                                            "score": scores[rows_, cols], "own": same.astype(np.int32)})
                        both = pd.concat([lists[int(n)], new]) if int(n) in lists else new
                        both = both.sort_values(["query", "score", "vec_id", "own"], ascending=[True, False, True, True], kind="stable")
                        lists[int(n)] = both[both.groupby("query").cumcount() <= k]
            pid = TaskContext.get().partitionId()
            for found in lists.values():
                if len(found):
                    yield pa.RecordBatch.from_pandas(found.assign(shard=np.int32(pid)), schema=pa.schema(FIELDS), preserve_index=False)

        return rows.mapInArrow(shard, SCHEMA)

    done = None
    for block in blocks:
        # one block at a time: its lists are on shared storage before the next block is searched
        part = written(_without_own(_merge_lists(written(search(block), "topk-lists"), k + 1, fan_in), k), "topk-block")
        done = part if done is None else done.unionByName(part)
    return done
