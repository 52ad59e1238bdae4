"""Repeated substrings by suffix arrays: every byte covered by a ``length``-byte string that also starts elsewhere.

A suffix array of the whole corpus does not fit one machine, so it is built in shards that can be sorted
apart.  Every ``length``-byte string has a content-defined anchor (``anchors.py``); equal strings have equal
anchors, so a shard holds whole groups of strings with one anchor hash:

1. Texts are cut into runs of strings with a common anchor.  Anchor hashes are counted (partial counts
   first); runs whose anchor occurs once cannot hold a repeated string and end there.
2. Equal runs are folded into one *piece* with its number of occurrences before any bytes move.  An anchor
   all of whose runs are one and the same piece has nothing left to sort: its strings occur that often.
3. All other anchors' pieces are dealt to shards with their bytes.  A shard sorts the suffixes of its
   pieces by induced sorting (``suffix_array.py``) and computes the permuted common prefixes; a string is
   repeated if its suffix shares ``length`` bytes with a neighbour in the array or its piece occurs twice.
4. An anchor with more than ``HOT_PIECES`` different pieces (a passage that a large part of the corpus
   quotes, each time between other words) would make one large shard.  Its pieces are split by further
   content: into blocks of neighbouring strings, dealt by the bytes around the anchor that all strings of a
   block share.  Equal blocks are folded again and the rest are sorted as in 2 and 3; a group still too large
   is split into smaller blocks, down to single strings, which have nothing left to sort.
5. Repeated strings go back to their occurrences and are united per document.

Texts are not shuffled: each task looks its own rows up in a table on shared storage that is laid out by
file (``lookups.py``), so ``docs`` must be a table of files.

Defined cases: null text is empty text; texts shorter than ``length`` lose nothing; repeated rows are separate
texts and lose what they share; a null id is kept; an empty table gives no rows; only the id and text
columns are read, so other names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.anchors import gram_hashes, runs
from lodgelake.llm.common import join_counted, shuffle_parts, written
from lodgelake.llm.lookups import beside_texts, lay_out, numbered, slices
from lodgelake.llm.suffix_array import permuted_lcp, suffix_array

#: Bytes of an anchor.
GRAM = 64
#: Bytes of text worked on at once when anchors are sought, and of pieces in one suffix array.
SLICE_BYTES, SHARD_BYTES = 2 << 20, 1 << 18
#: Pieces of one anchor that are sorted together; beyond, they are split by further content.
HOT_PIECES = 4000
#: Strings of the blocks that hot groups are split into, one size after another; the last must be 1.
BLOCKS = (16, 4, 1)


def text_runs(rows: DataFrame, length: int) -> DataFrame:
    """(key, piece, row, start, n): runs of ``n`` strings from ``start`` with anchor hash ``key``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest
        for part in slices(batches, SLICE_BYTES):
            texts = pc.fill_null(part.column("t"), b"").cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
            if ends[-1] == ends[0]:
                continue
            data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
            ends = ends - ends[0]
            key, text, start, n = runs(data, ends, length, min(GRAM, length))
            whole = memoryview(data)
            first = ends[text] + start
            piece = np.array([xxh3_64_intdigest(whole[a:b]) for a, b in zip(first.tolist(), (first + n + length - 1).tolist())],
                             dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(piece), part.column("row").take(pa.array(text)), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32))], names=["key", "piece", "row", "start", "n"])

    return rows.mapInArrow(cut, "key long, piece long, row struct<file:long,at:long>, start int, n int")


FOUND = "key long, piece long, n int, spans array<struct<at:int,n:int>>"


def repeated_starts(pieces: pa.LargeBinaryArray, often: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first start, number of starts) of the runs of starts whose ``length``-byte string occurs again, by a suffix array."""
    ends = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]
    sizes = np.diff(ends)
    # bytes from 2 on, 1 between pieces, 0 at the end (no UTF-8 byte reaches 254)
    s = np.ones(len(data) + len(sizes) + 1, dtype=np.int64)
    s[-1] = 0
    first = np.cumsum(sizes + 1) - sizes - 1
    s[np.arange(len(data)) + np.repeat(np.arange(len(sizes)), sizes)] = data.astype(np.int64) + 2
    sa = suffix_array(s)
    shares = permuted_lcp(s, sa, length) >= length
    again = shares.copy()
    again[sa[:-1]] |= shares[sa[1:]]
    again[:-1] |= np.repeat(often > 1, sizes + 1)
    # whole strings only: a piece's last length - 1 bytes and the mark after it start none
    starts = np.zeros(len(s) + 1, dtype=np.int8)
    starts[first] += 1
    starts[first + sizes - length + 1] -= 1
    again &= np.cumsum(starts[:-1]).astype(bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[0], again.astype(np.int8), [0]])))
    piece = np.searchsorted(first, edges[::2], side="right") - 1
    return piece, edges[::2] - first[piece], edges[1::2] - edges[::2]


def _sorted_shards(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated strings of (key, piece, n, often, bytes), whole keys to a shard."""
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            column = lambda name: table.column(name).combine_chunks()
            whole = column("bytes").cast(pa.large_binary())
            piece, at, n = repeated_starts(whole, column("often").to_numpy(), length)
            keep, counts = np.unique(piece, return_counts=True)
            spans = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))], names=["at", "n"]))
            return pa.RecordBatch.from_arrays([*(column(c).take(pa.array(keep)) for c in ("key", "piece", "n")), spans],
                                              names=["key", "piece", "n", "spans"])

        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            upto = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy())
            begin = before = 0
            # a shard may end where the key changes
            for i in np.flatnonzero(np.append(last is not None and key[0] != last, key[1:] != key[:-1])).tolist():
                sofar = int(upto[i - 1]) if i else 0
                if size + sofar - before >= SHARD_BYTES:
                    yield solve([*held, batch.slice(begin, i - begin)] if i > begin else held)
                    held, size, begin, before = [], 0, i, sofar
            held.append(batch.slice(begin))
            size += int(upto[-1]) - before
            last = key[-1]
        if held:
            yield solve(held)

    return (pieces.select("key", "piece", "n", "often", "bytes").repartition(shuffle_parts(pieces.sparkSession), "key")
            .sortWithinPartitions("key").mapInArrow(shards, FOUND))


def anchor_place(data: bytes, length: int) -> int:
    """Where in a piece the anchor lies that its strings have in common."""
    gram = min(GRAM, length)
    h = gram_hashes(np.frombuffer(data, dtype=np.uint8), gram)[:length - gram + 1]
    return int(np.argmin(h >> np.uint64(32)))


def blocks_of(n: int, anchor: int, width: int, length: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(number, first string, strings, first and end byte of what they share) of a piece's blocks of at most ``width`` strings.

    A block is the strings that begin so many bytes before the anchor, so equal strings are in equal blocks.
    """
    for k in range((anchor - n + 1) // width, anchor // width + 1):
        last = anchor - k * width  # of the whole block, of which the piece may have a part
        first = last - width + 1
        at = max(0, first)
        yield k, at, min(n - 1, last) - at + 1, last, first + length


def _split(pieces: DataFrame, length: int, widths: tuple[int, ...] = BLOCKS) -> DataFrame:
    """Repeated strings of (key, piece, n, often, anchor, bytes), whose keys have too many pieces for one shard.

    Pieces are cut into blocks of strings and dealt by the bytes that all strings of a block share.  Equal blocks are
    folded; groups of several go to shards, and those still too large are split into smaller blocks.
    """
    width, keys = widths[0], ["group", "part", "m"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest
        for batch in batches:
            out = []
            for key, piece, n, often, anchor, data in zip(*(c.to_pylist() for c in batch.columns)):
                anchor = anchor_place(data, length) if anchor is None else anchor
                for k, at, m, first, end in blocks_of(n, anchor, width, length):
                    group = xxh3_64_intdigest(key.to_bytes(8, "little", signed=True) + k.to_bytes(8, "little", signed=True) + data[first:end])
                    part = xxh3_64_intdigest(data[at:at + m + length - 1])
                    out.append((key, piece, n, at, m, anchor - at, often, group, part))
            if out:
                *columns, group, part = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.int64()])),
                     *(pa.array(np.array(c, dtype=np.uint64).view(np.int64)) for c in (group, part))],
                    names=["key", "piece", "n", "at", "m", "anchor", "often", "group", "part"])

    cuts = written(pieces.select("key", "piece", "n", "often", "anchor", "bytes").mapInArrow(
        cut, "key long, piece long, n int, at int, m int, anchor int, often long, group long, part long"), "blocks")
    folded = written(cuts.groupBy(*keys).agg(F.sum("often").alias("often"), F.count("*").alias("c"), F.min(F.struct(
        "key", "piece", "n", "at", "anchor")).alias("one")), "folded-blocks")
    kinds = folded.groupBy("group").agg(F.count("*").alias("kinds"))
    alone = folded.where("often > 1").join(kinds.where("kinds = 1"), "group").select(
        *keys, F.array(F.struct(F.lit(0).alias("at"), F.col("m").alias("n"))).alias("spans"))
    several = folded.join(kinds.where("kinds > 1"), "group").select(*keys, F.col("often").alias("times"), "kinds", "one.*")
    held = written(several.join(pieces.select("key", "piece", "n", "bytes"), ["key", "piece", "n"]).select(
        F.col("group").alias("key"), F.col("part").alias("piece"), F.col("m").alias("n"), F.col("times").alias("often"), "kinds", "anchor",
        F.substring("bytes", F.col("at") + 1, F.col("m") + (length - 1)).alias("bytes")), "block-bytes")
    sorted_ = _shards_and_splits(held, length, widths[1:])
    found = alone.unionByName(sorted_.select(F.col("key").alias("group"), F.col("piece").alias("part"), F.col("n").alias("m"), "spans"))
    # a block inside a passage that a large part of the corpus quotes is one of very many pieces
    found = written(found.join(folded.select(*keys, "c"), keys), "repeated-blocks")
    back = join_counted(cuts.select("key", "piece", "n", "at", *keys), found, keys, "c", cuts.count())
    return back.select("key", "piece", "n", F.explode(F.transform("spans", lambda s: F.struct(
        (F.col("at") + s["at"]).alias("at"), s["n"].alias("n")))).alias("s")).groupBy("key", "piece", "n").agg(F.collect_list("s").alias("spans"))


def _shards_and_splits(held: DataFrame, length: int, widths: tuple[int, ...]) -> DataFrame:
    """Repeated strings of (key, piece, n, often, kinds, anchor, bytes) by suffix arrays, in shards of whole keys or split further."""
    hot = held.where(F.col("kinds") > HOT_PIECES)
    if not widths or hot.isEmpty():
        return _sorted_shards(held, length)
    return _sorted_shards(held.where(F.col("kinds") <= HOT_PIECES), length).unionByName(_split(hot, length, widths))


def repeated_spans(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   schema: str = "doc_id long, n_bytes long, spans array<struct<first:int,last:int>>, kept binary") -> DataFrame:
    """doc_id, n_bytes, spans (half-open byte ranges to remove, maximal) and the kept bytes of every row."""
    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        spans = united(got[0][0] if got else [])
        yield doc_id, len(text), [{"first": a, "last": b} for a, b in spans], without(text, spans)

    return _repeats(docs, length, id_col, text_col, one, schema)


def digest(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the kept bytes of every row."""
    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        spans = united(got[0][0] if got else [])
        yield doc_id, len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(without(text, spans)).hexdigest()

    return _repeats(docs, length, id_col, text_col, one, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def united(spans: list[dict]) -> list[tuple[int, int]]:
    """Half-open ranges, joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["first"], x["last"]) for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _repeats(docs: DataFrame, length: int, id_col: str, text_col: str, one, schema: str) -> DataFrame:
    rows = numbered(docs, id_col, text_col)
    sizes = rows.select("row", F.coalesce(F.octet_length("t"), F.lit(0)).alias("size"))
    every = written(text_runs(rows, length), "runs")
    keys = written(every.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "repeated-anchors")
    runs_ = written(every.join(keys, "key"), "repeated-runs")
    pieces = written(runs_.groupBy("key", "piece", "n").agg(
        F.count("*").alias("often"), F.min(F.struct("row", "start")).alias("at")).select("key", "piece", "n", "often", "at.*"), "pieces")
    kinds = pieces.groupBy("key").agg(F.count("*").alias("kinds"))
    alone = pieces.join(kinds.where("kinds = 1"), "key").select("key", "piece", "n", F.array(F.struct(F.lit(0).alias("at"), "n")).alias("spans"))

    several = pieces.join(kinds.where("kinds > 1"), "key").join(sizes, "row")
    cuts = lay_out(several.groupBy("row", "size").agg(F.collect_list(F.struct("key", "piece", "n", "often", "kinds", "start")).alias("cuts")), "cuts")

    def bytes_of(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        for c in got[0][0]:
            yield c["key"], c["piece"], c["n"], c["often"], c["kinds"], text[c["start"]:c["start"] + c["n"] + length - 1]

    held = written(beside_texts(rows, cuts, "key long, piece long, n int, often long, kinds long, bytes binary", bytes_of, ["cuts"], False), "piece-bytes")
    found = alone.unionByName(_shards_and_splits(held.withColumn("anchor", F.lit(None).cast("int")), length, BLOCKS))
    first = F.col("start") + F.col("s.at")
    spans = (runs_.join(written(found, "repeated-strings"), ["key", "piece", "n"])
             .select("row", "start", F.explode("spans").alias("s"))
             .groupBy("row").agg(F.collect_list(F.struct(first.alias("first"), (first + F.col("s.n") + (length - 1)).alias("last"))).alias("spans"))
             .join(sizes, "row"))
    return beside_texts(rows, lay_out(spans, "spans"), schema, one, ["spans"], True)
