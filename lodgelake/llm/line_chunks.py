"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last ``CONTEXT`` non-blank lines marks about one line in ``AVERAGE`` as a
boundary: which lines are marked depends on them and the lines before only, so an insertion shifts nothing
further down.  A chunk runs from one boundary line to the next, both included.  A repeated run that holds no
whole chunk, or ends inside one, still has *short chunks*: each two neighbouring non-blank lines that are not
both boundaries (if both are, they are a chunk).  So every run of two or more non-blank lines is made of whole
chunks, wherever it lies.

Chunks are counted by hash over the whole corpus; the bytes of those that repeat are then compared, and of each
set of equal chunks all but the first in table order (by file and place) go: what is removed is the union of
their lines.  So a later copy of a run goes whole, and of every line that is in the corpus the first stays.
Where (A, B) and (B, C) are repeated in different places, A, B and C go, though the three never stood together:
each line of them is part of a repeated run.

Counts are folded per task before they move.  Texts stay where they lie (``lookups.py``): only the bytes of
chunks whose hash repeats travel, to be compared.

Defined cases: null text is empty text (one empty line, nothing to remove); a text without line breaks is a
single line and stays; blank lines inside a chunk belong to it and are compared, those before and after a run
stay; a chunk that overlaps the first of its kind (equal lines in a row) is no copy of it, so of many equal lines
the first two stay; repeated rows are separate texts, all but the first lose their runs; a null id is kept;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import written
from lodgelake.llm.lookups import ROW, beside_texts, lay_out, numbered

#: Non-blank lines that a boundary depends on, and lines from one boundary to the next on average.
CONTEXT, AVERAGE = 2, 4
_FACTOR, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def chunks(text: bytes) -> list[tuple[int, int, int, int]]:
    """(start, end, lines, non-blank lines) of the chunks and short chunks of a text, in order; ends include the line break."""
    from xxhash import xxh3_64_intdigest
    filled = []  # start, end, line number and boundary mark of the non-blank lines
    drop = pow(_FACTOR, CONTEXT, 1 << 64)
    recent: list[int] = []
    rolling = at = 0
    for i, line in enumerate(text.split(b"\n")):
        start, at = at, min(at + len(line) + 1, len(text))
        if line.strip():
            recent.append(xxh3_64_intdigest(line))
            rolling = (rolling * _FACTOR + recent[-1]) & _MASK
            if len(recent) > CONTEXT:
                rolling = (rolling - recent.pop(0) * drop) & _MASK
            filled.append((start, at, i, (rolling ^ (rolling >> 32)) % AVERAGE == 0))
    out = []
    last = None  # the last boundary
    for k, (_, end, i, boundary) in enumerate(filled):
        if k and not (boundary and filled[k - 1][3]):
            out.append((filled[k - 1][0], end, i - filled[k - 1][2] + 1, 2))
        if boundary:
            if last is not None:
                out.append((filled[last][0], end, i - filled[last][2] + 1, k - last + 1))
            last = k
    return sorted(out)


def chunk_bytes(text: bytes, start: int, end: int) -> bytes:
    """What is compared: the chunk's lines without the last line break."""
    return text[start:end - 1] if text[end - 1:end] == b"\n" else text[start:end]


def _hashed(rows: DataFrame) -> DataFrame:
    """(a, b, row, start, last, size): 128-bit hash and place of every multi-line chunk."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest
        for batch in batches:
            out = []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("t").to_pylist()):
                for start, end, _, _ in chunks(text) if text else ():
                    h = xxh3_128_intdigest(chunk_bytes(text, start, end))
                    out.append(((h >> 64) - (1 << 63), (h & _MASK) - (1 << 63), row, start, end, len(text)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), ROW, *[pa.int32()] * 3))],
                    names=["a", "b", "row", "start", "last", "size"])

    return rows.mapInArrow(cut, "a long, b long, row struct<file:long,at:long>, start int, last int, size int")


def _removed(docs: DataFrame, one, schema: str, id_col: str, text_col: str) -> DataFrame:
    rows = numbered(docs, id_col, text_col)
    hashed = _hashed(rows)
    again = written(hashed.groupBy("a", "b").agg(F.count("*").alias("c")).where("c > 1").select("a", "b"), "repeated-chunks")
    places = hashed.join(again, ["a", "b"]).groupBy("row", "size").agg(F.collect_list(F.struct("start", "last")).alias("places"))
    path = lay_out(places, "chunk-places")

    def compare(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        seen: dict[bytes, int] = {}  # ends of the first of their kind in this text
        for start, end in sorted((x["start"], x["last"]) for x in got[0][0]):
            b = chunk_bytes(text, start, end)
            yield row, len(text), start, end, int(seen.setdefault(b, end) <= start), b

    held = written(beside_texts(rows, path, "row struct<file:long,at:long>, size int, start int, last int, later int, bytes binary", compare, ["places"], False), "chunk-bytes")
    # equal bytes, not equal hashes, decide
    first = held.groupBy("bytes").agg(F.min("row").alias("first_row"), F.count("*").alias("c")).where("c > 1")
    gone = (held.join(first, "bytes").where("row <> first_row or later = 1")
            .groupBy("row", "size").agg(F.collect_list(F.struct("start", "last")).alias("gone")))
    return beside_texts(rows, lay_out(gone, "chunks-gone"), schema, one, ["gone"], True)


def _kept(text: bytes, got: list[tuple]) -> tuple[list[tuple[int, int, int, int]], bytes]:
    """The removed chunks of a text and what is left of it."""
    gone = {(x["start"], x["last"]) for x in got[0][0]} if got else set()
    cut = [c for c in chunks(text) if (c[0], c[1]) in gone] if gone else []
    left, at = [], 0
    for start, end, _, _ in cut:
        left.append(text[at:start])
        at = max(at, end)
    return cut, b"".join([*left, text[at:]])


def _lines(text: bytes, cut: list[tuple[int, int, int, int]]) -> int:
    """Lines in the union of chunks."""
    total = at = 0
    for start, end, lines, _ in cut:
        if end > at:
            total += lines if start >= at else text.count(b"\n", at, end) + (text[end - 1:end] != b"\n")
            at = end
    return total


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the text without later copies of multi-line chunks, for every row."""
    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        yield doc_id, _kept(text, got)[1].decode()

    return _removed(docs, one, "doc_id long, text string", id_col, text_col)


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_chunks, n_removed chunks, n_removed_lines, n_removed_bytes and kept_sha256 of every row."""
    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        gone, left = _kept(text, got)
        yield (doc_id, text.count(b"\n") + 1, len(chunks(text)), len(gone), _lines(text, gone), len(text) - len(left),
               hashlib.sha256(left).hexdigest())

    return _removed(docs, one, "doc_id long, n_lines long, n_chunks long, n_removed long, n_removed_lines long, "
                               "n_removed_bytes long, kept_sha256 string", id_col, text_col)
