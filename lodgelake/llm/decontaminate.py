"""Benchmark decontamination by a distributed positional inverted index.

Index.  The corpus is cut into segments of whole documents; each segment is one stored row with, for
every term that the test set uses, the ordered list of the term's word positions, plus the ids and
word counts of its documents.  The index is split by documents, not by terms, so a term that a third
of all documents hold is spread over all segments.

Search.  Terms are ranked by their number of postings in the whole corpus.  For a phrase the postings
of its rarest term, less the term's offset, are the possible starts; they are intersected with the
offset-adjusted lists of the next rarer terms, and what is left after the last term is an exact match
inside one document.  All phrases of a segment are intersected together as sorted arrays.
``nearby`` answers proximity questions from the same postings.

The test set is read in blocks of at most ``BLOCK_WORDS`` words, each a pass of its own, so what is sent
to the tasks is bounded however large the test set grows; one block is the common case.

Words are maximal runs of bytes other than ASCII characters that are neither digits nor letters, with
A-Z in lower case.  A window is ``window`` consecutive words of an item; a shorter item is one window.

Defined cases: null text has no words; items without words have no windows; items with a null id mark
words but are not listed; ids that repeat are listed once; a document without words is clean; a
document longer than a segment is a segment by itself; an empty corpus gives no rows, an empty test set
only clean rows.  Only the id and text columns of either table are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import written
from lodgelake.llm.lookups import ROW, row_name, text_size, without_rows

#: Words of the test set that one pass searches.
BLOCK_WORDS = 2_000_000
#: Bytes of text in a segment (a longer document is a segment by itself).
SEGMENT_BYTES = 4 << 20
#: Possible starts that are intersected at once.
STARTS_AT_ONCE = 2_000_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True

SEGMENT = ("segment long, doc_ids array<{id}>, doc_words array<int>, terms array<int>, counts array<int>, "
           "positions array<int>")
FOUND = "row long, doc_id {id}, n_words long, spans array<struct<first:int,last:int>>, items array<string>"
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
#: Types of document ids: numbers, or names of rows with the size of their text.
NAMED = "struct<file:long,at:long,size:long>"
IDS = {"long": pa.int64(), NAMED: pa.struct([*ROW, ("size", pa.int64())])}


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order (binary array) and the number of words of each text."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "").cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(texts) or ends[0] == ends[-1]:
        return pa.array([], pa.large_binary()), np.zeros(len(texts), dtype=np.int64)
    low = _LOWER[np.frombuffer(texts.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]]
    ends = ends - ends[0]
    inside = _WORD[low]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    edge = ends[:-1][ends[:-1] < len(low)]
    starts[edge] = inside[edge]
    at = np.flatnonzero(starts)
    kept = np.append(0, np.cumsum(inside))
    offsets = np.append(kept[at], kept[-1]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(low[inside]))])
    return words, np.diff(np.searchsorted(at, ends))


@dataclass
class Phrases:
    """One block of test phrases: term numbers of a block vocabulary, grouped by length."""

    vocabulary: pa.Array
    items: list[str | None] = field(default_factory=list)
    by_length: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)  # terms [n, length], item number

    @staticmethod
    def of(rows: list[tuple[str | None, list[bytes]]], window: int) -> "Phrases":
        vocabulary = sorted({w for _, words in rows for w in words})
        number = {w: i for i, w in enumerate(vocabulary)}
        found: dict[int, tuple[list, list]] = {}
        for k, (_, words) in enumerate(rows):
            terms = [number[w] for w in words]
            length = min(window, len(terms))
            for i in range(len(terms) - length + 1 if length else 0):
                found.setdefault(length, ([], []))
                found[length][0].append(terms[i:i + length])
                found[length][1].append(k)
        return Phrases(pa.array(vocabulary, pa.large_binary()), [i for i, _ in rows],
                       {n: (np.array(t, dtype=np.int64).reshape(-1, n), np.array(k)) for n, (t, k) in found.items()})


def phrase_blocks(items: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[Phrases]:
    """The test set in blocks; an item longer than a block goes on in the next, overlapping by a window."""
    rows: list[tuple[str | None, list[bytes]]] = []
    n = 0
    for r in items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        words = words_of(pa.array([r["t"]], pa.string()))[0].to_pylist()
        step = BLOCK_WORDS
        for at in range(0, max(1, len(words) - (window - 1)), step):
            rows.append((r["i"], words[at:at + step + window - 1]))
            n += len(rows[-1][1])
            if n >= BLOCK_WORDS:
                yield Phrases.of(rows, window)
                rows, n = [], 0
    if rows:
        yield Phrases.of(rows, window)


def build_index(docs: DataFrame, vocabulary: pa.Array, id_type: str = "long") -> DataFrame:
    """Postings of the vocabulary's terms, one row per segment (see SEGMENT), on shared storage."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary.to_pylist())

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        terms_known = pa.array(sent.value, pa.large_binary())
        segment = TaskContext.get().partitionId() << 24  # below: 2**24 segments a task, 2**20 documents each
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            group = (np.cumsum(size) - size) // SEGMENT_BYTES
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                words, counts = words_of(batch.column(1).slice(a, b - a))
                term = pc.index_in(words, terms_known)
                at = np.flatnonzero(~term.is_null().to_numpy(zero_copy_only=False))
                term = term.fill_null(-1).to_numpy()[at]
                order = np.argsort(term, kind="stable")
                present, each = np.unique(term, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([segment], pa.int64()),
                    "doc_ids": pa.array([batch.column(0).slice(a, b - a).to_pylist()], pa.list_(IDS[id_type])),
                    "doc_words": pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                    "terms": pa.array([present.astype(np.int32)], pa.list_(pa.int32())),
                    "counts": pa.array([each.astype(np.int32)], pa.list_(pa.int32())),
                    "positions": pa.array([at[order].astype(np.int32)], pa.list_(pa.int32()))})
                segment += 1

    source = docs.select("doc_id", F.col("text").cast("binary").alias("t"))
    return written(source.mapInArrow(segments, SEGMENT.format(id=id_type)), "postings")


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """Postings of every term of the block vocabulary in the whole corpus."""
    rows = (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
            .groupBy("x.terms").agg(F.sum("x.counts").alias("n")).collect())
    out = np.zeros(n_terms, dtype=np.int64)
    for r in rows:
        out[r["terms"]] = r["n"]
    return out


class Postings:
    """One segment's lists as a sorted array of (term, position), with its documents' word ranges."""

    def __init__(self, row: dict[str, pa.Scalar]):
        self.doc_ids = row["doc_ids"].as_py()
        list_of = lambda c: row[c].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.doc_words = list_of("doc_words")
        self.first = np.append(0, np.cumsum(self.doc_words))
        self.keys = (np.repeat(list_of("terms"), list_of("counts")) << 32) | list_of("positions")

    def range_of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.keys, terms << 32), np.searchsorted(self.keys, (terms + 1) << 32)

    def holds(self, terms: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Whether a term is at a position."""
        if not len(self.keys):
            return np.zeros(len(terms), dtype=bool)
        key = (terms << 32) | np.maximum(positions, 0)
        return (self.keys[np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)] == key) & (positions >= 0)

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        """The document that holds a position (documents without words hold none)."""
        return np.searchsorted(self.first, positions, side="right") - 1

    def rarest(self, phrases: np.ndarray, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(phrase numbers, positions of their rarest term, order of offsets by rarity) in bounded parts."""
        order = np.argsort(rank[phrases], axis=1, kind="stable")
        lo, hi = self.range_of(phrases[np.arange(len(phrases)), order[:, 0]])
        part = (np.cumsum(hi - lo) - (hi - lo)) // STARTS_AT_ONCE
        for p in np.unique(part[hi > lo]):
            own = np.flatnonzero((part == p) & (hi > lo))
            n = (hi - lo)[own]
            which = np.repeat(own, n)
            at = np.arange(len(which)) + np.repeat(lo[own] - (np.cumsum(n) - n), n)
            yield which, self.keys[at] & 0xFFFFFFFF, order

    def exact(self, phrases: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase number, first word) of every exact occurrence inside one document."""
        length = phrases.shape[1]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for which, at, order in self.rarest(phrases, rank):
            start = at - order[which, 0]
            ok = start >= 0
            which, start = which[ok], start[ok]
            ok = start + length <= self.first[np.minimum(self.doc_of(start) + 1, len(self.first) - 1)]
            which, start = which[ok], start[ok]
            for k in range(1, length):
                offset = order[which, k]
                ok = self.holds(phrases[which, offset], start + offset)
                which, start = which[ok], start[ok]
                if not len(which):
                    break
            found.append((which, start))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def near(self, phrases: np.ndarray, rank: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase number, position of its rarest term) where all its terms lie within ``reach`` words of it."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for which, at, order in self.rarest(phrases, rank):
            doc = self.doc_of(at)
            low, high = np.maximum(at - reach, self.first[doc]), np.minimum(at + reach, self.first[doc + 1] - 1)
            ok = np.ones(len(at), dtype=bool)
            for k in range(1, phrases.shape[1]):
                term = phrases[which, order[which, k]]
                i = np.minimum(np.searchsorted(self.keys, (term << 32) | low), len(self.keys) - 1)
                ok &= (self.keys[i] >= (term << 32) | low) & (self.keys[i] <= (term << 32) | high)
            found.append((which[ok], at[ok]))
        return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _search(index: DataFrame, block: Phrases, rank: np.ndarray, reach: int | None, id_type: str) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast((block.items, block.by_length, rank))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, by_length, rank = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                postings = Postings(row)
                n_docs = len(postings.doc_ids)
                spans: list[list] = [[] for _ in range(n_docs)]
                hits: list[set] = [set() for _ in range(n_docs)]
                for length, (phrases, item) in by_length.items():
                    which, at = postings.exact(phrases, rank) if reach is None else postings.near(phrases, rank, reach)
                    doc = postings.doc_of(at)
                    size = length if reach is None else 1
                    pairs = np.unique(np.stack([doc, at - postings.first[doc]]), axis=1)
                    for d, a in pairs.T.tolist():
                        spans[d].append((a, a + size))
                    for d, k in np.unique(np.stack([doc, item[which]]), axis=1).T.tolist():
                        if items[k] is not None:
                            hits[d].add(items[k])
                yield pa.RecordBatch.from_pydict({
                    "row": pa.array(row["segment"].as_py() * (1 << 20) + np.arange(n_docs), pa.int64()),
                    "doc_id": pa.array(postings.doc_ids, IDS[id_type]),
                    "n_words": pa.array(postings.doc_words, pa.int64()),
                    "spans": pa.array([[{"first": a, "last": b} for a, b in merged(s)] for s in spans], SPANS),
                    "items": pa.array([sorted(h) for h in hits], pa.list_(pa.string()))})

    return index.mapInArrow(search, FOUND.format(id=id_type))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open word ranges, joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def find_items(docs: DataFrame, items: DataFrame, window: int = 13, reach: int | None = None, id_col: str = "doc_id",
               item_col: str = "item_id", text_col: str = "text", id_type: str = "long") -> DataFrame:
    """doc_id, n_words, hit spans (half-open word ranges) and item ids of every document.

    With ``reach`` the terms of a window need only lie within so many words of its rarest term, and a
    span is that term's place.  ``id_type`` is one of ``IDS``.
    """
    docs = docs.select(F.col(id_col).cast(id_type).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = phrase_blocks(items, window, item_col, text_col)
    first = next(blocks, None)
    second = next(blocks, None)
    if first is None:
        first = Phrases.of([], window)
    if second is not None:
        docs = written(docs, "corpus")  # several passes must see the same segments

    def one(block: Phrases) -> DataFrame:
        index = build_index(docs, block.vocabulary, id_type)
        return _search(index, block, term_counts(index, len(block.vocabulary)), reach, id_type)

    if second is None:
        return one(first).drop("row")
    found = written(one(first).unionByName(one(second)), "found")
    for block in blocks:
        found = found.unionByName(written(one(block), "found"))
    both = found.groupBy("row", "doc_id", "n_words").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [[{"first": a, "last": b} for a, b in merged([(x["first"], x["last"]) for x in s])] for s in batch.column("spans").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("spans"), "spans", pa.array(spans, SPANS))

    return both.drop("row").mapInArrow(join, both.drop("row").schema)


def contamination(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20, id_col: str = "doc_id",
                  id_type: str = "long") -> DataFrame:
    """``find_items`` with n_hit words and contaminated: one word in ``share`` or more is hit."""
    found = find_items(docs, items, window, id_col=id_col, id_type=id_type)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))))


def clean_rows(docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The rows that are not contaminated, columns as they came.

    Every row is judged by its own text and named by file and place (``lookups.py``), so ids may be null or repeat
    and only the names of rows that go are shuffled.  ``docs`` must be a table of files.
    """
    row = row_name(docs)
    rows = docs.select(F.struct(row["file"].alias("file"), row["at"].alias("at"), text_size().alias("size")).alias("row"), "text")
    bad = contamination(rows, items, window, share, "row", NAMED).where("contaminated")
    return without_rows(docs, bad.select(F.struct("doc_id.file", "doc_id.at").alias("row"), "doc_id.size"))
