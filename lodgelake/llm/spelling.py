"""Spelling variants by Bloom-guided neighbourhoods of a vocabulary.

Words are runs of the letters a-z and U+00C0-U+00FF; two are near if one inserted, deleted or replaced letter
makes one of the other.

1. Vocabulary.  Tasks count words in memory and hand on partial counts; Spark adds them up.
2. Filters.  Words are dealt by length to split-block Bloom filters: a word's hash names a block of 512 bits and
   one bit in each of its eight lanes.  Blocks are made by a grouped ``bit_or``.
3. Probes.  Each word's edits are generated in matrices: a word's hash is a sum of one term per place and letter,
   so every deletion and replacement costs a few additions.  Insertions are the deletions of the other word, and
   of a replaced pair the word with the smaller letter asks.  At most ``FILTER_BYTES`` of filter are
   broadcast at once; a larger vocabulary takes several rounds over ranges of blocks, each probe asking in the round
   that holds its block.
4. Only edits that a filter holds are shuffled, to an exact join with the vocabulary, which drops the false ones.
5. A word's form is its near word of largest count if that is ``ratio`` times its own or more.  Counts grow along
   forms, so chains are short: roots follow by doubling, in a number of rounds that the largest count sets.

``rewrite`` may change a run of a document before it is counted, to one that is not longer.

Defined cases: null and empty texts hold no words; only A-Z are lower-cased; rows that repeat are counted each;
ties of count go to the smallest form in code-point order; a null id is handed to ``rewrite`` as None; an empty
table gives no rows; only the id and text columns are read, so other names cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import written
from lodgelake.llm.lookups import slices

Rewrite = Callable[[int | None, str], str]
#: Bytes of text counted at once, and different words a task holds before it hands partial counts on.
SLICE_BYTES, HELD_WORDS = 4 << 20, 1 << 19
#: Filter bits per word, bytes of a block, and the most filter bytes that are broadcast at once.
BITS, BLOCK, FILTER_BYTES = 16, 64, 16 << 20
#: Edits whose hashes are held at once.
PROBES = 1 << 20
_GOLDEN, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def vocabulary(docs: DataFrame, min_length: int = 6, min_count: int = 5, id_col: str = "doc_id", text_col: str = "text",
               rewrite: Rewrite | None = None) -> DataFrame:
    """word and n: the words of at least ``min_length`` letters that occur at least ``min_count`` times."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a rewritten run is not longer, so shorter runs than the least length need no look
        find = re.compile("[a-zÀ-ÿ]{%d,}" % max(min_length, 1)).findall
        held: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for part in slices(batches, SLICE_BYTES):
            for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("t").to_pylist()):
                runs = find((text or b"").lower().decode())  # bytes lower-case A-Z only
                if rewrite is None:
                    held.update(runs)
                    continue
                for run, c in Counter(runs).items():
                    held[rewrite(doc_id, run)] += c
            if len(held) > HELD_WORDS:
                yield handed_on()
                held.clear()
        if held:
            yield handed_on()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return (rows.mapInArrow(counted, "word string, n long").where(F.length("word") >= min_length)
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


def planted_slip(doc_id: int | None, run: str) -> str:
    """The rewriting of the registered query: one run in 199 (by hash of id and run) loses a letter.

    Runs of documents without an id stay.
    """
    if doc_id is None:
        return run
    h = crc32(run.encode(), crc32(b"%d:" % doc_id))
    if h % 199:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


# Letters are below U+0100, so a word is a row of bytes in Latin-1.

def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _term(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to a word's hash."""
    return _mixed((place.astype(np.uint64) * np.uint64(256) + letter.astype(np.uint64) + np.uint64(1)) * _GOLDEN)


def word_sums(letters: np.ndarray) -> np.ndarray:
    """Unmixed hashes of the rows of a matrix of letters."""
    return _term(np.arange(letters.shape[1])[None, :], letters).sum(axis=1, dtype=np.uint64)


def _place(sums: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and the 48 bits that name one bit in each lane."""
    h = _mixed(sums)
    return ((_mixed(h ^ _GOLDEN) >> np.uint64(11)) % np.uint64(blocks)).astype(np.int64), (h & np.uint64(2 ** 48 - 1)).astype(np.int64)


def _edits(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, sums, word, place, letter) of all edits of equally long words; letter 0 is a deletion.

    Of equal neighbouring letters only the first is deleted, and replacements only raise a letter: every
    near pair of words is met exactly once.
    """
    n, length = letters.shape
    terms = _term(np.arange(length)[None, :], letters)
    total = terms.sum(axis=1, dtype=np.uint64)
    step = max(1, PROBES // max(1, len(alphabet) + 1) // max(1, n))
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    moved = np.zeros_like(terms)  # terms of the letters one place further left
    moved[:, 1:] = _term(np.arange(length - 1)[None, :], letters[:, 1:])
    after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1] - moved
    for a in range(0, length, step):
        b = min(a + step, length)
        part = letters[:, a:b]
        new = np.ones((n, b - a), dtype=bool)
        new[:, max(0, 1 - a):] = letters[:, max(a, 1):b] != letters[:, max(a, 1) - 1:b - 1]
        w, i = np.nonzero(new)
        yield length - 1, (before[:, a:b] + after[:, a:b])[w, i], w, i + a, np.zeros(len(w), dtype=np.uint8)
        w, i, c = np.nonzero(alphabet[None, None, :] > part[:, :, None])
        letter = alphabet[c]
        yield length, total[w] - terms[:, a:b][w, i] + _term(i + a, letter), w, i + a, letter


def _edited(word: bytes, place: int, letter: int) -> str:
    return (word[:place] + (bytes([letter]) if letter else b"") + word[place + 1:]).decode("latin-1")


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, numbers of the words, matrix of their letters), a bounded number of letters at a time."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        rows = max(1, PROBES // (96 * n))
        for k in range(0, len(at), rows):
            some = at[k:k + rows]
            yield n, some, np.frombuffer("".join(words[i] for i in some).encode("latin-1"), dtype=np.uint8).reshape(len(some), n)


def _filter_blocks(words: DataFrame, blocks: dict[int, int]) -> DataFrame:
    """(length, block, eight lanes): the split-block Bloom filter of every length."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, at, letters in _by_length(batch.column("word").to_pylist()):
                block, bits = _place(word_sums(letters), blocks[n])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), n, dtype=np.int32)), pa.array(block), pa.array(bits)],
                                                 names=["length", "block", "bits"])

    lane = lambda i: F.expr(f"bit_or(shiftleft(1L, cast(shiftright(bits, {6 * i}) & 63 as int)))").alias(f"lane{i}")
    return words.select("word").mapInArrow(place, "length int, block long, bits long").groupBy("length", "block").agg(*[lane(i) for i in range(8)])


def _rounds(blocks: dict[int, int]) -> Iterator[dict[int, tuple[int, int]]]:
    """Ranges of blocks per length, together at most FILTER_BYTES."""
    room, now = FILTER_BYTES // BLOCK, {}
    for length, n in sorted(blocks.items()):
        a = 0
        while a < n:
            b = min(n, a + room)
            now[length] = (a, b)
            room -= b - a
            a = b
            if not room:
                yield now
                room, now = FILTER_BYTES // BLOCK, {}
    if now:
        yield now


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, m: every pair of near words of a table (word, n), once, ``other`` shorter or with the larger letter."""
    spark = words.sparkSession
    counts = {r["length"]: r["c"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("c")).collect()}  # one row per length
    blocks = {n: -(-c * BITS // (8 * BLOCK)) for n, c in counts.items()}
    letters = words.select(F.explode(F.split("word", "")).alias("x")).where("x <> ''").distinct().collect()  # at most 90
    alphabet = np.array(sorted(ord(r["x"]) for r in letters), dtype=np.uint8)
    table = written(_filter_blocks(words, blocks), "bloom-blocks")

    def asked(ranges: dict[int, tuple[int, int]]) -> DataFrame:
        held: dict[int, tuple[int, int, np.ndarray]] = {n: (a, b, np.zeros((b - a, 8), dtype=np.uint64)) for n, (a, b) in ranges.items()}
        wanted = F.lit(False)
        for n, (a, b) in ranges.items():
            wanted = wanted | ((F.col("length") == n) & (F.col("block") >= a) & (F.col("block") < b))
        found = table.where(wanted).toArrow()  # at most FILTER_BYTES / BLOCK rows
        length, block = found["length"].to_numpy(), found["block"].to_numpy()
        lanes = np.stack([found[f"lane{i}"].to_numpy() for i in range(8)], axis=1).view(np.uint64)
        for n, (a, _, array) in held.items():
            mine = length == n
            array[block[mine] - a] = lanes[mine]
        sent = spark.sparkContext.broadcast(held)

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, n_of = batch.column("word").to_pylist(), batch.column("n").to_pylist()
                for _, at, matrix in _by_length(texts):
                    for length, sums, w, place, letter in _edits(matrix, alphabet):
                        if length not in sent.value:
                            continue
                        a, b, lanes = sent.value[length]
                        block, bits = _place(sums, blocks[length])
                        left = np.flatnonzero((block >= a) & (block < b))
                        for i in range(8):
                            bit = ((bits[left] >> (6 * i)) & 63).astype(np.uint64)
                            left = left[((lanes[block[left] - a, i] >> bit) & np.uint64(1)) == 1]
                        if len(left):
                            who = at[w[left]].tolist()
                            other = [_edited(matrix[x].tobytes(), p, c) for x, p, c in zip(w[left].tolist(), place[left].tolist(), letter[left].tolist())]
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([texts[x] for x in who]), pa.array([n_of[x] for x in who], pa.int64()), pa.array(other)], names=["word", "n", "other"])

        return words.select("word", "n").mapInArrow(probe, "word string, n long, other string")

    exact = words.select(F.col("word").alias("other"), F.col("n").alias("m"))
    pairs = None
    for ranges in _rounds(blocks):
        # one round at a time: its pairs are on shared storage before the next filter is sent
        part = written(asked(ranges).join(exact, "other").select("word", "n", "other", "m"), "near-pairs")
        pairs = part if pairs is None else pairs.unionByName(part)
    return pairs if pairs is not None else spark.createDataFrame([], "word string, n long, other string, m long")


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a table (word, n)."""
    if ratio < 2:
        raise ValueError("forms must be more frequent than their variants: ratio 2 or more")
    words = written(words, "vocabulary")
    spread = words.repartition("word")  # enough tasks for the probes, whatever the files
    pairs = near_pairs(spread)
    both = pairs.unionByName(pairs.select(F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("minus"), "other")).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    formed = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.minus")).alias("form_n")), "forms")
    top = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(top, ratio)) + 1)  # a chain multiplies the count each time
    to = formed.where("form is not null").select("word", F.col("form").alias("to"))
    for _ in range(math.ceil(math.log2(steps)) + 1):
        further = to.select(F.col("word").alias("to"), F.col("to").alias("on"))
        to = written(to.join(further, "to", "left").select("word", F.coalesce("on", "to").alias("to")), "roots")
    return formed.join(to, "word", "left").select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n")
