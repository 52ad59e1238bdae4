"""Quality scores: random Fourier features, ridge regression by summed normal equations, isotonic calibration.

Every whole text becomes a few statistics (lengths, character classes, repetition).  They are
standardised and mapped to ``n_features`` cosines whose products approximate a Gaussian kernel.  Each
partition of labelled rows sums its part of the normal equations; the parts meet in a tree and one
matrix of fixed size reaches the driver.  All labelled training rows are used.  Two halves of them are
fitted separately and score each other, and a monotone step function of those scores (pool adjacent
violators over fixed score bins) turns raw scores into probabilities.

A score depends on the text alone.  Defined cases: null text is empty text and gets a score; rows with a
null id are scored and count as held out; several labels of one id are averaged, null labels ignored; with
no labels at all every score is 0.5; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import written

#: Cosines of the feature map, its kernel width in standard deviations, ridge weight per labelled row.
N_FEATURES, WIDTH, RIDGE = 256, 6.0, 1e-4
#: Score bins of the calibration over [-0.5, 1.5).
BINS = 2000
#: Partial sums that meet in one task.
FAN_IN = 16

_CLASSES = np.full(256, 6, dtype=np.uint8)  # 6: other marks
_CLASSES[0x80:] = 0                         # 0: letters beyond ASCII (and continuation bytes)
_CLASSES[0x61:0x7B] = 1                     # 1: lower case
_CLASSES[0x41:0x5B] = 2                     # 2: upper case
_CLASSES[0x30:0x3A] = 3                     # 3: digits
_CLASSES[[0x20, 9, 10, 11, 12, 13]] = 4     # 4: white space
_CLASSES[[ord(c) for c in ".,;:!?'\"-()"]] = 5  # 5: prose marks
N_STATS = 20


def _word_stats(text: bytes) -> tuple[float, ...]:
    words = text.lower().split()
    n = len(words)
    if not n:
        return (0.0,) * 10
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), dtype=np.int32, count=n)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return (n, len(counts) / n, np.log1p(len(counts)) / np.log1p(n), max(counts.values()) / n,
            sum(map(eq, words, words[1:])) / n, float((lengths <= 3).mean()), float((lengths > 12).mean()),
            float(lengths.std()), len(lines), 1 - len(set(lines)) / max(1, len(lines)))


def text_statistics(texts: pa.Array) -> np.ndarray:
    """One row of N_STATS numbers for each text."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "").cast(pa.large_binary())
    n = len(texts)
    out = np.zeros((n, N_STATS))
    if not n:
        return out
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    if ends[-1] > ends[0]:
        kind = _CLASSES[np.frombuffer(texts.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]]]
        at = ends - ends[0]
        size = np.maximum(np.diff(at), 1)
        for k in range(7):
            upto = np.append(0, np.cumsum(kind == k, dtype=np.int64))
            out[:, k] = np.diff(upto[at])
        counts = out[:, :7].copy()
        words = np.array([_word_stats(t) for t in texts.to_pylist()])
        n_words = np.maximum(words[:, 0], 1)
        out[:, :5] = counts[:, :5] / size[:, None]
        out[:, 5:7] = np.log1p(10 * counts[:, 5:7] / n_words[:, None])
        out[:, 7] = np.log1p(np.diff(at))
        out[:, 8] = np.log1p(words[:, 0])
        out[:, 9] = np.minimum((counts.sum(axis=1) - counts[:, 4]) / n_words, 50)
        out[:, 10:17] = words[:, 1:8]
        out[:, 17] = np.log1p(words[:, 0] / np.maximum(words[:, 8], 1))
        out[:, 18] = words[:, 9]
        out[:, 19] = np.log1p(words[:, 8])
    return out


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """crc32 of the id as text falls in the held-out remainder; a null id does too."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(True))


@dataclass
class QualityModel:
    """What a score needs: standardisation, feature map, weights and the calibration's corner points."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]
    seed: int = 5

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        directions = rng.normal(size=(stats.shape[1], N_FEATURES)) / WIDTH
        phases = rng.uniform(0, 2 * np.pi, N_FEATURES)
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ directions + phases) * np.sqrt(2 / N_FEATURES)
        return np.hstack([waves, np.ones((len(stats), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), *self.knots), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins (sorted x, mean y, weight n); corner points of the fit."""
    blocks: list[list[float]] = []  # mean, weight, weighted x
    for xi, yi, ni in zip(x, y, n):
        blocks.append([yi, ni, xi * ni])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            m, w, s = blocks.pop()
            m0, w0, s0 = blocks[-1]
            blocks[-1] = [(m0 * w0 + m * w) / (w0 + w), w0 + w, s0 + s]
    return np.array([s / w for _, w, s in blocks]), np.array([m for m, _, _ in blocks])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and stats of every row, from its whole text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                stats = text_statistics(part.column(1))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(np.arange(len(stats) + 1, dtype=np.int32) * N_STATS, stats.ravel())],
                    names=["doc_id", "stats"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t")
                       ).mapInArrow(compute, "doc_id long, stats array<double>")


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, N_STATS)


def _tree_sum(parts: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the blobs of equal kind; (kind, slot, blob) rows meet FAN_IN at a time."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for kind, slot, blob in zip(*(c.to_pylist() for c in b.columns)):
                x = np.frombuffer(blob)
                sums[kind, slot] = sums[kind, slot] + x if (kind, slot) in sums else x
        if sums:
            yield pa.RecordBatch.from_pydict({"kind": [k for k, _ in sums], "slot": [s for _, s in sums],
                                              "blob": [x.tobytes() for x in sums.values()]},
                                             schema=pa.schema([("kind", pa.int32()), ("slot", pa.int32()), ("blob", pa.binary())]))

    while True:
        parts = written(parts, "normal-equations")
        slots = parts.agg(F.countDistinct("slot")).first()[0]
        if slots <= FAN_IN:
            break
        parts = (parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
                 .repartition(-(-slots // FAN_IN), "slot").mapInArrow(add, parts.schema))
    out: dict[int, np.ndarray] = {}
    for r in parts.collect():
        x = np.frombuffer(r["blob"])
        out[r["kind"]] = out[r["kind"]] + x if r["kind"] in out else x
    return out


def _summed(rows: DataFrame, part_of) -> dict[int, np.ndarray]:
    """Sum ``part_of(stats, y) -> blob`` over each half (kind 0, 1) of the rows (stats, y, half)."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            stats, y, half = _matrix(b, "stats"), b.column("y").to_numpy(), b.column("half").to_numpy()
            for k in np.unique(half):
                x = part_of(stats[half == k], y[half == k])
                sums[int(k)] = sums[int(k)] + x if int(k) in sums else x
        for k, x in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"kind": pa.array([k], pa.int32()), "slot": pa.array([TaskContext.get().partitionId()], pa.int32()), "blob": [x.tobytes()]})

    return _tree_sum(rows.mapInArrow(one, "kind int, slot int, blob binary"))


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> QualityModel:
    """Fit on the labelled rows of ``stats`` that are not held out."""
    y = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id"))
         .agg(F.avg(F.col(label_col).cast("double")).alias("y")))
    rows = written(stats.where(~held_out("doc_id")).join(y, "doc_id")
                   .select("stats", "y", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")), "labelled")
    moments = _summed(rows, lambda s, y: np.concatenate([[len(y), y.sum()], s.sum(axis=0), (s * s).sum(axis=0)]))
    if not moments:
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(N_FEATURES + 1), (np.zeros(1), np.full(1, 0.5)))
    total = sum(moments.values())
    mean = total[2:2 + N_STATS] / total[0]
    scale = np.sqrt(np.maximum(total[2 + N_STATS:] / total[0] - mean ** 2, 1e-12))
    base = QualityModel(mean, np.where(scale < 1e-6, 1.0, scale), np.zeros(N_FEATURES + 1), (np.zeros(1), np.zeros(1)))

    def equations(s: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = base.cosines(s)
        return np.concatenate([(x.T @ x).ravel(), x.T @ y, [len(y)]])

    sums = _summed(rows, equations)
    d = N_FEATURES + 1

    def solve(x: np.ndarray) -> np.ndarray:
        a = x[:d * d].reshape(d, d) + RIDGE * max(x[-1], 1) * np.diag(np.append(np.ones(d - 1), 1e-9))
        return np.linalg.solve(a + 1e-9 * np.eye(d), x[d * d:d * d + d])

    whole = solve(sum(sums.values()))
    # each half is scored by the other half's weights; a lone half has to score itself
    other = {k: solve(sums.get(1 - k, sums[k])) for k in sums}

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, half = base.cosines(_matrix(b, "stats")), b.column("half").to_numpy()
            raw = np.zeros(len(half))
            for k, w in other.items():
                raw[half == k] = x[half == k] @ w
            at = np.clip(np.floor((raw + 0.5) * (BINS / 2)), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), b.column("y")], names=["bin", "y"])

    bins = rows.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.avg("y").alias("y"), F.count("*").alias("n")).collect()
    bins.sort(key=lambda r: r["bin"])
    centre = np.array([(r["bin"] + 0.5) / (BINS / 2) - 0.5 for r in bins])
    base.weights = whole
    base.knots = isotonic(centre, np.array([r["y"] for r in bins]), np.array([float(r["n"]) for r in bins]))
    return base


def scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    stats = written(document_statistics(docs), "statistics")
    model = fit(stats, labels, label_col)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(_matrix(b, "stats")))], names=["doc_id", "score"])

    scored = stats.mapInArrow(apply, "doc_id long, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """The rows whose text scores ``threshold`` or more, columns as they came; texts stay where they are."""
    model = fit(written(document_statistics(docs), "statistics"), labels, label_col)
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                good = model.score(text_statistics(part.column(at))) >= threshold
                yield part.filter(pa.array(good))

    return docs.mapInArrow(keep, docs.schema)
