"""Substring dedup over windows of words: a word goes if a window of ``width`` words that covers it is also in
a document of a smaller id.

Windows are compared by Rabin-Karp hashes: with a word's hash h and an odd base B, prefix sums of h * B^i modulo
2^64 give the hash of any stretch of words by one subtraction and one product, two bases give 128 bits.

1. A window's *anchor* is the stretch of ``GRAM`` words in it of least hash; equal windows have equal anchors, so
   a text falls into runs of windows with one anchor.  Every window is counted by its anchor first: windows
   whose anchor lies in documents of one id only cannot repeat and end there.
2. Equal runs are folded into one *piece* with the least id that holds it.  An anchor all of whose runs are one
   piece is settled by it.
3. The windows of all other pieces get their 128-bit hashes and are counted in Spark (least id per hash, partial
   results first), and the least ids go back to the pieces.
4. Windows with a smaller id elsewhere meet the occurrences of their piece, are united per document into maximal
   intervals and looked up where the text lies; texts are never shuffled (``lookups.py``), so ``docs`` must be a
   table of files.

Copies of a passage cost one row each in steps 1 and 4 whatever their number, and no step pairs them.  Every join knows
how many rows a key has: those of hot keys stay where they lie and meet their few keys by broadcast (``join_counted``).

Defined cases: null text has no words; white space is ASCII white space; a text of fewer words than ``width``
stays whole; rows of equal id are one document here and lose nothing to each other; a null id comes after all
ids (as the largest long does), so rows without one lose what others hold, but nothing to each other; windows
are judged on the input; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.anchors import runs_of
from lodgelake.llm.common import join_counted, written
from lodgelake.llm.lookups import beside_texts, lay_out, numbered, slices

#: Words of an anchor.
GRAM = 16
#: Bytes of text that one pass over anchors works on.
SLICE_BYTES = 1 << 20
#: Words whose hashes a task remembers.
REMEMBERED = 1 << 20
#: The id of rows without one: after all others.
LAST = 2 ** 63 - 1
# Odd numbers of the Rabin-Karp hashes and of the final mixing.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class _Hashes(dict):
    """Number of every word met so far; the two hashes of word number k are ``both[k]``."""

    def __init__(self):
        super().__init__()
        self.both: list[tuple[int, int]] = []

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_128_intdigest
        h = xxh3_128_intdigest(word)
        self.both.append((h >> 64, h & (2 ** 64 - 1)))
        self[word] = len(self.both) - 1
        return len(self.both) - 1


class Stretches:
    """Rabin-Karp hashes of all stretches of a sequence of words."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums, self.back = [], []
        for k, base in enumerate(_BASES):
            power = np.cumprod(np.append(np.uint64(1), np.full(n, base, dtype=np.uint64)))
            self.back.append(np.cumprod(np.append(np.uint64(1), np.full(n, pow(base, -1, 1 << 64), dtype=np.uint64))))
            self.sums.append(np.append(np.uint64(0), np.cumsum(hashes[:, k] * power[:n])))

    def hash(self, k: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash ``k`` of the words from ``first`` up to, not including, ``last``."""
        h = (self.sums[k][last] - self.sums[k][first]) * self.back[k][first]
        h ^= h >> np.uint64(32)
        h *= _MIX
        return h ^ (h >> np.uint64(29))


def _numbers(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def window_runs(rows: DataFrame, width: int) -> DataFrame:
    """(key, piece, row, doc, size, start, n): runs of ``n`` windows from word ``start`` with anchor hash ``key``."""
    gram = min(GRAM, width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for part in slices(batches, SLICE_BYTES):
            if len(known) > REMEMBERED:
                known = _Hashes()
            texts = [t or b"" for t in part.column("t").to_pylist()]
            numbers = [_numbers(t.split(), known) for t in texts]
            ends = np.cumsum([0, *(len(x) for x in numbers)])
            if ends[-1] < width:
                continue
            of = Stretches(np.array(known.both, dtype=np.uint64)[np.concatenate(numbers)])
            at = np.arange(ends[-1])
            # stretches that run past the last word are in no window
            grams = of.hash(0, at, np.minimum(at + gram, ends[-1]))
            key, text, start, n = runs_of(grams, ends, width, gram)
            first = ends[text] + start
            piece = of.hash(1, first, first + n + width - 1).view(np.int64)
            take = pa.array(text)
            size = np.array([len(t) for t in texts], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(piece), part.column("row").take(take), part.column("doc").take(take),
                 pa.array(size[text]), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["key", "piece", "row", "doc", "size", "start", "n"])

    return (rows.select("row", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "t")
            .mapInArrow(cut, "key long, piece long, row struct<file:long,at:long>, doc long, size int, start int, n int"))


def _hashed_windows(rows: DataFrame, path: str, width: int) -> DataFrame:
    """The windows (at, a, b) of looked-up pieces with their 128-bit hashes, and what is known of the piece."""
    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        known = _Hashes()
        numbers = _numbers(text.split(), known)
        of = Stretches(np.array(known.both, dtype=np.uint64)[numbers])
        for c in got[0][0]:
            first = c["start"] + np.arange(c["n"])
            a, b = (of.hash(k, first, first + width).view(np.int64).tolist() for k in (0, 1))
            for at, x, y in zip(range(c["n"]), a, b):
                yield c["key"], c["piece"], c["n"], c["least"], c["most"], c["often"], at, x, y

    return beside_texts(rows, path, "key long, piece long, n int, least long, most long, often long, at int, a long, b long", one, ["cuts"], False)


def _joined(windows: str):
    """Windows (at, least) in order of place, neighbours of equal least id as one span (at, n, least)."""
    none = F.array().cast("array<struct<at:int,n:int,least:long>>")

    def add(spans, w):
        last = F.element_at(spans, -1)
        grown = F.struct(last["at"].alias("at"), (last["n"] + 1).alias("n"), last["least"].alias("least"))
        new = F.struct(w["at"].alias("at"), F.lit(1).alias("n"), w["least"].alias("least"))
        goes_on = (F.size(spans) > 0) & (last["least"] == w["least"]) & (last["at"] + last["n"] == w["at"])
        return F.when(F.coalesce(goes_on, F.lit(False)), F.concat(F.slice(spans, 1, F.greatest(F.size(spans) - 1, F.lit(0))), F.array(grown))).otherwise(
            F.concat(spans, F.array(new)))

    return F.aggregate(F.array_sort(windows), none, add)


def repeated_windows(rows: DataFrame, width: int) -> DataFrame:
    """(row, size, spans): half-open word ranges of windows that a document of a smaller id holds as well."""
    every = written(window_runs(rows, width), "window-runs")
    keys = written(every.groupBy("key").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("of_key"))
                   .where("lo < hi").select("key", "of_key"), "shared-anchors")
    total = every.count()  # from the files' footers
    shared = written(join_counted(every, keys, ["key"], "of_key", total).drop("of_key"), "shared-runs")
    pieces = written(shared.groupBy("key", "piece", "n").agg(
        F.min("doc").alias("least"), F.max("doc").alias("most"), F.count("*").alias("often"), F.min(F.struct("row", "size", "start")).alias("at"))
        .select("key", "piece", "n", "least", "most", "often", "at.*"), "window-pieces")
    kinds = pieces.groupBy("key").agg(F.count("*").alias("kinds"))
    judged = join_counted(pieces, written(kinds, "anchor-kinds"), ["key"], "kinds", pieces.count())
    alone = (judged.where("kinds = 1 and least < most")
             .select("key", "piece", "n", "often", F.array(F.struct(F.lit(0).alias("at"), "n", "least")).alias("found")))
    cuts = lay_out(judged.where("kinds > 1").groupBy("row", "size").agg(
        F.collect_list(F.struct("key", "piece", "n", "least", "most", "often", "start")).alias("cuts")), "window-cuts")
    windows = written(_hashed_windows(rows, cuts, width), "windows")
    # a piece's own copies count through its least id
    least = windows.groupBy("a", "b").agg(F.min("least").alias("_least"), F.count("*").alias("of_window"))
    several = (join_counted(windows, written(least, "least-ids"), ["a", "b"], "of_window", windows.count())
               .where("_least < most").groupBy("key", "piece", "n", "often")
               .agg(F.collect_list(F.struct("at", F.col("_least").alias("least"))).alias("w"))
               .select("key", "piece", "n", "often", _joined("w").alias("found")))
    found = written(alone.unionByName(several), "repeated-windows")
    first = F.col("start") + F.col("s.at")
    return (join_counted(shared, found, ["key", "piece", "n"], "often", shared.count())
            .select("row", "size", "doc", "start", F.explode("found").alias("s"))
            .where(F.col("s.least") < F.col("doc")).groupBy("row", "size")
            .agg(F.collect_list(F.struct(first.alias("first"), (first + F.col("s.n") + (width - 1)).alias("last"))).alias("spans")))


def united(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal half-open ranges; those that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((x["first"], x["last"]) for x in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, removed spans (half-open word ranges, maximal) and the kept words, joined by spaces, of every row."""
    rows = numbered(docs, id_col, text_col)

    def one(row: dict, doc_id: int | None, text: bytes, got: list[tuple]) -> Iterator[tuple]:
        words = text.split()
        spans = united(got[0][0]) if got else []
        edges = [0, *(x for s in spans for x in s), len(words)]
        kept = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]] if spans else words
        yield doc_id, len(words), [{"first": a, "last": b} for a, b in spans], b" ".join(kept).decode()

    return beside_texts(rows, lay_out(repeated_windows(rows, width), "window-spans"),
                        "doc_id long, n_words long, spans array<struct<first:int,last:int>>, text string", one, ["spans"], True)
