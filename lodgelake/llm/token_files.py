"""Token ids in Arrow files of equal-length sequences.

Documents are put in ascending id order by a range exchange; each range partition streams its token
ids into one Arrow IPC file whose record batches hold two fixed-size lists per row: ``ids`` (the
sequence) and ``mask`` (true for real ids, false for the padding of the last sequence).  Lists of one
size lie back to back in one buffer, so a memory-mapped file gives any sequence, or any run of ids,
as a view without copying.  A second small file names each document's first id and number of ids.

Encoding uses the ``tokenizers`` library.  Its byte-level pre-tokenizer never joins a non-space
character to a following blank, so a text is cut at such blanks and equal pieces are encoded once per
task; the ids equal those of the whole text (tests compare both).

Files get a new name in every task attempt and only the attempts that Spark accepted are listed, so a
lost executor or a second attempt leaves no half-written or doubled data in the result.

Defined cases: a null or empty text is just the end id; null ids sort first; rows that repeat an id
stay separate, ordered by text, and are dealt over partitions by how their texts begin; an empty table gives no files and no rows; a text longer than a
sequence or a batch runs on over as many as it needs.  Only the id and text columns are read.
"""

from __future__ import annotations

import functools
import os
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.llm.common import local_path, scratch, shuffle_parts

#: A worker process keeps the ids of at most so many different pieces, over all its tasks.
CACHE_PIECES = 1_000_000
#: Characters of a text that help to cut the range of one id (null ids, say) into partitions.
RANGE_CHARS = 32
#: Texts are encoded in slices of about so many bytes (a longer text is one slice).
SLICE_BYTES = 16 << 20


def piece_cuts(data: np.ndarray) -> np.ndarray:
    """Marks the bytes of UTF-8 text that the byte-level pre-tokenizer always starts a token at.

    Its pattern never goes on from a non-space character to white space, nor from a letter to a
    punctuation mark, and takes a single line break between two other characters by itself.  Only
    cases that single bytes decide are marked; a boundary left unmarked makes a longer piece, no
    other result.
    """
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n < 2:
        return cut
    prev, this = data[:-1], data[1:]
    visible = (prev > 0x20) & (prev < 0x7F)
    letter = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    cut[1:] = (this == 0x20) & visible
    # the last byte of a two-byte character with lead C3 to DF, none of which is white space
    cut[2:] |= (this[1:] == 0x20) & (prev[1:] >= 0x80) & (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    mark = (this == 0x2E) | (this == 0x2C) | ((this >= 0x21) & (this <= 0x26)) | (this == 0x2A) | (this == 0x7C)
    cut[1:] |= mark & letter[:-1]
    line = (this[:-1] == 0x0A) & visible[:-1] & letter[2:]
    cut[1:-1] |= line
    cut[2:] |= line
    return cut


class PieceEncoder:
    """Ids of whole texts by a ``tokenizers`` file; equal pieces are encoded once."""

    def __init__(self, path: str, dtype: str = "<u2"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = dtype
        self.known: dict[bytes, bytes] = {}
        self.added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        found = list(map(self.known.get, pieces))
        new = [i for i, x in enumerate(found) if x is None]
        if len(self.known) + len(new) > CACHE_PIECES:
            self.known.clear()
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            texts = [pieces[i].decode() for i in part]
            for i, e in zip(part, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                found[i] = self.known[pieces[i]] = array(self.code, e.ids).tobytes()
        return found

    @property
    def code(self) -> str:
        return "H" if self.dtype == "<u2" else "I"

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (null: none) and where each text's ids start; one entry more than texts."""
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
        first, last = int(ends[0]), int(ends[-1])
        if last == first:
            return np.zeros(0, dtype=self.dtype), np.zeros(len(texts) + 1, dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[first:last]
        ends = ends - first
        cut = piece_cuts(data)
        whole = data.tobytes()
        for token in self.added:  # found in a text before it is cut, so none is cut apart
            at = whole.find(token)
            while at >= 0:
                cut[at + 1:at + len(token)] = False
                at = whole.find(token, at + 1)
        cut[ends[:-1][ends[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        offsets = np.append(starts, len(data)).astype(np.int64)
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        which = pieces.indices.to_numpy()
        ids = self._ids(pieces.dictionary.to_pylist())
        size = np.dtype(self.dtype).itemsize
        n_ids = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // size
        flat = np.frombuffer(b"".join(ids), dtype=self.dtype)
        piece_n = n_ids[which]
        upto = np.append(0, np.cumsum(piece_n))
        at = np.repeat((np.cumsum(n_ids) - n_ids)[which] - upto[:-1], piece_n)
        at += np.arange(len(at))
        return flat[at], upto[np.searchsorted(starts, ends)]


@functools.lru_cache(maxsize=1)
def worker_encoder(path: str, dtype: str) -> PieceEncoder:
    """One encoder for each Python worker process, so its pieces serve all of its tasks."""
    return PieceEncoder(path, dtype)


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    path = local_path(folder)
    if path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(folder)


class TokenFileWriter:
    """Streams documents into one sequence file and one document index."""

    def __init__(self, folder: str, seq_len: int, dtype: str, sequences_per_batch: int = 256):
        fs, path = _filesystem(folder)
        fs.create_dir(path, recursive=True)
        self.name = f"{folder}/{uuid.uuid4().hex}"
        base = f"{path}/{self.name.rsplit('/', 1)[1]}"
        self.seq_len, self.dtype, self.rows = seq_len, np.dtype(dtype), sequences_per_batch
        kind = pa.from_numpy_dtype(self.dtype)
        self.schema = pa.schema([("ids", pa.list_(kind, seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])
        self.index_schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
        self.data_out, self.index_out = fs.open_output_stream(f"{base}.arrow"), fs.open_output_stream(f"{base}.index.arrow")
        self.data = pa.ipc.new_file(self.data_out, self.schema)
        self.index = pa.ipc.new_file(self.index_out, self.index_schema)
        self.pending, self.pending_bytes, self.docs = [], 0, []
        self.n_tokens = self.n_docs = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.docs.append((doc_id, self.n_tokens, n))
        self.n_tokens += n
        self.n_docs += 1
        self.pending.append(ids)
        self.pending_bytes += len(ids)
        if self.pending_bytes >= self.rows * self.seq_len * self.dtype.itemsize:
            self._flush(False)
        if len(self.docs) >= 8192:
            self._flush_index()

    def _flush(self, last: bool) -> None:
        flat = np.frombuffer(b"".join(self.pending), dtype=self.dtype)
        step = self.seq_len * self.rows
        at = 0
        while len(flat) - at >= step or (last and at < len(flat)):
            part = flat[at:at + step]
            rows = -(-len(part) // self.seq_len)
            ids = np.zeros(rows * self.seq_len, dtype=self.dtype)
            ids[:len(part)] = part
            mask = np.arange(len(ids)) < len(part)
            self.data.write_batch(pa.record_batch([
                pa.FixedSizeListArray.from_arrays(pa.array(ids), self.seq_len),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.seq_len)], schema=self.schema))
            at += len(part)
        rest = flat[at:].tobytes()
        self.pending, self.pending_bytes = [rest], len(rest)

    def _flush_index(self) -> None:
        if self.docs:
            self.index.write_batch(pa.record_batch(
                [pa.array(c, type=pa.int64()) for c in zip(*self.docs)], schema=self.index_schema))
            self.docs = []

    def close(self) -> None:
        self._flush(True)
        self._flush_index()
        for x in (self.data, self.index, self.data_out, self.index_out):
            x.close()


class TokenFile:
    """Random access to one written file; a mounted folder is memory-mapped, so nothing is copied."""

    def __init__(self, name: str):
        fs, path = _filesystem(name)
        opened = (lambda p: pa.memory_map(p)) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file
        self._data, self._index = opened(f"{path}.arrow"), opened(f"{path}.index.arrow")
        reader = pa.ipc.open_file(self._data)
        self.batches = [reader.get_batch(i) for i in range(reader.num_record_batches)]
        self.seq_len = reader.schema.field("ids").type.list_size
        self.ids = [b.column(0).flatten().to_numpy(zero_copy_only=True) for b in self.batches]
        self.starts = np.cumsum([0, *[len(x) for x in self.ids]])

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (a view) and mask of sequence ``i``."""
        b = int(np.searchsorted(self.starts, i * self.seq_len, side="right")) - 1
        at = i * self.seq_len - int(self.starts[b])
        mask = self.batches[b].column(1).flatten().slice(at, self.seq_len).to_numpy(zero_copy_only=False)
        return self.ids[b][at:at + self.seq_len], mask

    def runs(self, start: int, n: int) -> Iterator[np.ndarray]:
        """Views of the ids from ``start`` on, one for each record batch that they lie in."""
        b = int(np.searchsorted(self.starts, start, side="right")) - 1
        while n > 0:
            at = start - int(self.starts[b])
            part = self.ids[b][at:at + n]
            yield part
            start, n, b = start + len(part), n - len(part), b + 1

    def documents(self) -> Iterator[pa.RecordBatch]:
        reader = pa.ipc.open_file(self._index)
        for i in range(reader.num_record_batches):
            yield reader.get_batch(i)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about SLICE_BYTES of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = 0,
                      seq_len: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Write ``docs`` and return the list of files in id order: name, first id, ids, documents.

    The list has one entry per range partition, which is all that reaches the driver.
    """
    spark = docs.sparkSession
    folder = folder or scratch(spark, "token-files")
    from tokenizers import Tokenizer
    dtype = "<u2" if Tokenizer.from_file(tokenizer).get_vocab_size() <= 2 ** 16 else "<u4"
    end = np.array([end_id], dtype=dtype).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        writer = encoder = None
        for batch in batches:
            if writer is None:
                writer, encoder = TokenFileWriter(folder, seq_len, dtype), worker_encoder(tokenizer, dtype)
            for part in slices(batch):
                ids, starts = encoder.encode(part.column(1))
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    writer.add(doc_id, ids[starts[i]:starts[i + 1]].tobytes() + end)
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "name": [writer.name],
                "n_docs": pa.array([writer.n_docs], pa.int64()), "n_tokens": pa.array([writer.n_tokens], pa.int64())})

    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    # beginnings are in the order of the whole texts, and short enough for the bounds that the driver holds
    ranges = [order[0], F.substring("text", 1, RANGE_CHARS).asc_nulls_first()]
    files = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
             .repartitionByRange(shuffle_parts(spark), *ranges).sortWithinPartitions(*order)
             .mapInArrow(encode, "part int, name string, n_docs long, n_tokens long").collect())
    out, first = [], 0
    for r in sorted(files, key=lambda r: r["part"]):
        out.append({"name": r["name"], "first": first, "n_tokens": r["n_tokens"], "n_docs": r["n_docs"]})
        first += r["n_tokens"]
    return out


def read_documents(spark: SparkSession, files: list[dict]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (ids as little-endian uint32) of every document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                source = TokenFile(files[i]["name"])
                for docs in source.documents():
                    crcs = []
                    for start, n in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                        crc = 0
                        for run in source.runs(start, n):
                            crc = zlib.crc32(run.astype("<u4", copy=False).tobytes(), crc)
                        crcs.append(crc)
                    starts = docs.column(1).to_numpy() + files[i]["first"]
                    yield pa.RecordBatch.from_arrays(
                        [docs.column(0), pa.array(starts), docs.column(2), pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(files), 1, len(files)).mapInArrow(read, schema)
