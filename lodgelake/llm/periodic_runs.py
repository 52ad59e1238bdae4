"""Periodic runs of words by a dictionary of basic factors.

A run is a stretch of words that repeats with some smallest period q at least twice and that no neighbouring
word extends.  Documents are independent, so Spark spreads them and every task works through slices of text:

1. Names.  Words get numbers; the factor of m = 2, 4, 8, ... words at a place gets the pair of the names of its
   halves as name, renumbered by sorting.  Factors that occur once in their document cannot begin a repetition
   and are dropped at every length, so ordinary prose has hardly any left from four words on.
2. Proposals.  The occurrences of a factor of m words in order of place fall into arithmetic progressions:
   successors at most m / 2 apart are all apart by the factor's own period.  A progression proposes that period;
   the differences below 2 m between a progression and the next three propose the longer ones.  Every difference
   of two progressions is proposed, because where both are cut off by a run's ends only an inner one is right.
   A run of period q in [m, 2 m) has a factor of m words that recurs q later, so no run is missed; periods
   below 4 are found with factors of 4 words, as runs are 12 words or longer.
3. Extension and deduplication.  Proposals of one period that touch are one stretch; stretches are extended to
   both sides word by word.  A stretch is found once for each multiple of its period: the least one stays.

``rewrite`` may change the words of a document before it is searched.

Defined cases: null text has no words; white space is ASCII white space; a text of fewer words than
``min_length`` has no run; repeated rows are separate documents; a null id is kept (and handed to
``rewrite`` as None); an empty table gives no rows; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.lookups import slices

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]
#: Bytes of text that one search works on (one longer text is searched by itself).
SEARCH_BYTES = 2 << 20
#: Words of the factors that propose the short periods.
SHORTEST = 4


def _renamed(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names 0, 1, ... of the keys that occur at least twice, and their places, in order of (name, place)."""
    if not len(key):
        return key, at
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    same = key[1:] == key[:-1]
    again = np.append(False, same) | np.append(same, False)
    return (np.cumsum(np.append(True, ~same)) - 1)[again], at[again]


def _proposals(name: np.ndarray, at: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): the word at ``place`` and the m - 1 after it recur one period later."""
    linked = name[1:] == name[:-1]
    gap = np.diff(at)
    tight = linked & (gap <= m // 2)
    chain = np.cumsum(np.append(True, ~tight)) - 1
    first = np.flatnonzero(np.append(True, ~tight))  # first occurrence of every progression
    places, periods = [], []
    if m == SHORTEST:
        places.append(at[:-1][tight])
        periods.append(gap[tight])
    for step in (1, 2, 3):
        # each occurrence with the start of a later progression, and the start of an earlier one with each occurrence
        j = np.flatnonzero(chain + step < len(first))
        other = first[chain[j] + step]
        ok = name[other] == name[j]
        places.append(at[j[ok]])
        periods.append(at[other[ok]] - at[j[ok]])
        j = np.flatnonzero((chain >= step) & (first[chain] != np.arange(len(at))))
        other = first[chain[j] - step]
        ok = name[other] == name[j]
        places.append(at[other[ok]])
        periods.append(at[j[ok]] - at[other[ok]])
    place, period = np.concatenate(places), np.concatenate(periods)
    ok = (period < 2 * m) & ((period >= m) | (m == SHORTEST))
    return place[ok], period[ok]


def _matches(w: np.ndarray, x: int, d: int, step: int) -> int:
    """Number of places from ``x`` on, in direction ``step``, whose word recurs ``d`` later."""
    n, size = 0, 16
    while True:
        a, b = (x + n, min(x + n + size, len(w) - d)) if step > 0 else (max(x - n - size + 1, 0), x - n + 1)
        if a >= b:
            return n
        differ = np.flatnonzero(w[a:b] != w[a + d:b + d])
        if len(differ):
            return n + int(differ[0] if step > 0 else b - a - 1 - differ[-1])
        n, size = n + b - a, 2 * size


def runs_in(w: np.ndarray, min_length: int) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of every run in numbered words.

    Words of different documents have different numbers and documents are kept apart by numbers that occur once.
    """
    found: dict[tuple[int, int], int] = {}
    name, at = _renamed(w, np.arange(len(w)))
    m = 1
    while len(at):
        if m >= SHORTEST:
            place, period = _proposals(name, at, m)
            order = np.lexsort((place, period))
            place, period = place[order], period[order]
            touch = (period[1:] == period[:-1]) & (place[1:] - place[:-1] <= m)
            edges = np.flatnonzero(np.append(True, ~touch))
            lasts = np.append(edges[1:], len(place)) - 1
            done = (0, -1)  # period and end of the last stretch
            for a, b in zip(edges.tolist(), lasts.tolist()) if len(place) else ():
                d, x, y = int(period[a]), int(place[a]), int(place[b]) + m
                if d == done[0] and x < done[1]:
                    continue
                x -= _matches(w, x - 1, d, -1)
                y += _matches(w, y, d, 1)
                done = (d, y)
                if y - x + d >= max(min_length, 2 * d):
                    found[x, y + d] = min(d, found.get((x, y + d), d))
        # names of twice the length
        of = np.full(len(w) + m, -1, dtype=np.int64)
        of[at] = name
        pair = of[at + m]
        ok = pair >= 0
        name, at = _renamed(name[ok] * (len(w) + 1) + pair[ok], at[ok])
        m *= 2
    return sorted((x, y, d) for (x, y), d in found.items())


def _search(texts: list[list[bytes]], min_length: int) -> list[list[tuple[int, int, int]]]:
    """Runs of every text, places counted from its own first word."""
    numbers = count()
    ids: list[int] = [next(numbers)]
    starts = []
    for words in texts:
        starts.append(len(ids))
        number = defaultdict(numbers.__next__)
        ids.extend([number[x] for x in words])
        ids.append(next(numbers))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = runs_in(np.array(ids, dtype=np.int64), min_length)
    which = np.searchsorted(starts, [x for x, _, _ in found], side="right") - 1
    for k, (x, y, d) in zip(which.tolist(), found):
        out[k].append((x - starts[k], y - starts[k], d))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), dtype=bool)
    for x, y, d in runs:
        keep[x + d:y] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, min_length: int = 12, id_col: str = "doc_id", text_col: str = "text",
                  rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; in that order) and the collapsed text of every row."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SEARCH_BYTES):
            ids = part.column("doc_id").to_pylist()
            texts = [(t or b"").split() for t in part.column("t").to_pylist()]
            if rewrite is not None:
                texts = [rewrite(i, t) for i, t in zip(ids, texts)]
            runs = _search(texts, min_length)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[{"start": x, "length": y - x, "period": d} for x, y, d in r] for r in runs], RUNS),
                 pa.array([b" ".join(collapsed(t, r)).decode() for t, r in zip(texts, runs)], pa.string())],
                names=["doc_id", "n_words", "runs", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return rows.mapInArrow(search, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string")


def longest(runs: str) -> Column:
    """The run of greatest length (ties: smallest start, then period) of an array of runs; null if there is none."""
    best = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.when(best.isNotNull(), F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period")))


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The rewriting of the registered query: a tenth of the documents (by hash of the id) end in repetitions.

    A document without an id stays as it is.
    """
    n = len(words)
    if doc_id is None or n == 0:
        return words
    h = crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]
