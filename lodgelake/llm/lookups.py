"""Decisions brought to the texts instead of texts to the decisions.

Rows of a table scan are named by file and place in the file, which no scan changes however Spark cuts the
files into partitions.  What an operator finds out about a row is written to shared storage, sorted by that
name, and the next scan reads, batch by batch, the few rows that concern its own texts.  So a corpus is
scanned several times but never shuffled.

``docs`` must be a table of files.  Every lookup carries the size of its text, and a task fails rather than
apply it to another one (a file that was replaced between two scans).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import local_path, scratch, shuffle_parts

#: Folders that the lookups of all files are dealt over.
FOLDERS = 512
#: Bytes of text (and of what is made of it) held before a batch of results is handed on.
SLICE_BYTES = 4 << 20
ROW = pa.struct([("file", pa.int64()), ("at", pa.int64())])


def row_name(docs: DataFrame) -> Column:
    """Struct (file, at): the hashed path of a row's file and the row's place in it."""
    meta = docs.metadataColumn("_metadata")
    return F.struct(F.xxhash64(meta["file_path"]).alias("file"), meta["row_index"].alias("at"))


def numbered(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, t): texts as bytes with the name of their row."""
    return docs.select(row_name(docs).alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("t"))


def slices(batches: Iterator[pa.RecordBatch], size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts hold about ``size`` bytes (one longer text is a batch)."""
    for batch in batches:
        n = pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(n) - n) // size
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def lay_out(df: DataFrame, name: str) -> str:
    """Write rows with a ``row`` column in folders by file, sorted by row; returns the path."""
    path = scratch(df.sparkSession, name)
    (df.withColumn("file", F.col("row.file")).withColumn("at", F.col("row.at")).drop("row")
     .withColumn("folder", F.pmod("file", F.lit(FOLDERS)))
     .repartitionByRange(shuffle_parts(df.sparkSession), "folder", "file", "at").sortWithinPartitions("folder", "file", "at")
     .write.partitionBy("folder").parquet(path))
    return path


def finder(path: str, columns: list[str]) -> Callable[[pa.StructArray, dict[int, tuple]], dict[tuple, list[tuple]]]:
    """A function of a batch's row names (and a cache of folders) to what ``lay_out`` wrote about them: (size, *columns) tuples."""
    local = local_path(path)

    def files_of(folder: int) -> tuple[pafs.FileSystem, list[str]]:
        fs, at = (pafs.LocalFileSystem(), local) if local else pafs.FileSystem.from_uri(path)
        at = f"{at}/folder={folder}"
        if fs.get_file_info(at).type == pafs.FileType.NotFound:
            return fs, []
        return fs, [i.path for i in fs.get_file_info(pafs.FileSelector(at)) if not i.base_name.startswith(("_", "."))]

    def read(file: int, first: int, last: int, folders: dict[int, tuple]) -> dict[tuple, list[tuple]]:
        folder = file % FOLDERS
        if folder not in folders:
            folders[folder] = files_of(folder)
        fs, paths = folders[folder]
        found: dict[tuple, list[tuple]] = {}
        for p in paths:
            with fs.open_input_file(p) as f:
                table = pq.read_table(f, columns=["at", "size", *columns],
                                      filters=[("file", "=", file), ("at", ">=", first), ("at", "<=", last)])
            for at, *values in zip(*(c.to_pylist() for c in table.columns)):
                found.setdefault((file, at), []).append(tuple(values))
        return found

    def find(rows: pa.StructArray, folders: dict[int, tuple]) -> dict[tuple, list[tuple]]:
        file, at = (rows.field(k).to_numpy() for k in (0, 1))
        found: dict[tuple, list[tuple]] = {}
        for f in np.unique(file).tolist():
            places = at[file == f]
            found.update(read(f, int(places.min()), int(places.max()), folders))
        return found

    return find


def beside_texts(rows: DataFrame, path: str, schema: str,
                 one: Callable[[dict, int | None, bytes, list[tuple]], Iterator[tuple]], columns: list[str], every: bool) -> DataFrame:
    """Run ``one(row, doc_id, text, looked-up tuples)`` where each text lies; with ``every`` also where nothing is found."""
    find = finder(path, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folders: dict[int, tuple] = {}
        for batch in batches:
            found = find(batch.column("row"), folders)
            for part in slices(iter([batch])):
                out = []
                for row, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    got = found.get((row["file"], row["at"]), [])
                    text = text or b""
                    if any(x[0] != len(text) for x in got):
                        raise RuntimeError("a file of the documents was replaced between two scans")
                    if got or every:
                        out.extend(one(row, doc_id, text, [x[1:] for x in got]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out), types)], names=names)

    fields = [f.strip().split(" ", 1) for f in schema.split(", ")]
    names = [n for n, _ in fields]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string(), "struct<file:long,at:long>": ROW,
             "array<struct<first:int,last:int>>": pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))}
    types = [kinds[k] for _, k in fields]
    return rows.mapInArrow(run, schema)


def text_size(text_col: str = "text") -> Column:
    """Bytes of a text, -1 for null."""
    return F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(-1)).cast("long")


def without_rows(docs: DataFrame, gone: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``gone`` (row, size as ``text_size`` gives it) names, columns as they came.

    Each task looks up which of its rows go; no text is shuffled.
    """
    find = finder(lay_out(gone.select("row", "size"), "gone"), [])
    names = docs.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folders: dict[int, tuple] = {}
        for batch in batches:
            rows, sizes, *columns = batch.columns
            part = pa.RecordBatch.from_arrays(columns, names=names)
            found = find(rows, folders)
            if found:
                keys = list(zip(*(rows.field(k).to_pylist() for k in (0, 1))))
                for key, size in zip(keys, sizes.to_pylist()):
                    if key in found and found[key][0][0] != size:
                        raise RuntimeError("a file of the documents was replaced between two scans")
                part = part.filter(pa.array([key not in found for key in keys]))
            yield part

    # by place, so that no column's name can clash
    return (docs.select(row_name(docs), text_size(text_col), *[F.col(f"`{c}`") for c in names])
            .toDF("_row", "_size", *[f"c{k}" for k in range(len(names))]).mapInArrow(keep, docs.schema))
