import hashlib
import random
from zlib import crc32

import numpy as np
import pytest

from lodgelake.llm import queries
from lodgelake.llm.periodic_runs import _search, periodic_runs

WHITE = {" ", "\t", "\n", "\v", "\f", "\r"}


def words_of(text):
    return "".join(" " if c in WHITE else c for c in text or "").split(" ") if text else []


def brute(words, min_length=12):
    """Every period against every place."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(min_length, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((x, y, q) for (x, y), q in found.items())


def digest(doc_id, text):
    words = [w for w in words_of(text) if w]
    n = len(words)
    if n and doc_id is not None and crc32(str(doc_id).encode()) % 10 == 0:
        g = crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = [(x, y - x, q) for x, y, q in brute(words)]
    gone = {i for x, length, q in runs for i in range(x + q, x + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("letters", [1, 2, 3, 4])
def test_runs_equal_brute_force(letters):
    rng = random.Random(letters)
    for _ in range(150):
        texts = [[rng.choice("abcd"[:letters]).encode() for _ in range(rng.randint(0, 90))] for _ in range(rng.randint(1, 5))]
        assert _search(texts, 12) == [brute(t) for t in texts]


def test_words_with_long_and_nested_periods():
    """Fibonacci words, repetitions of repetitions, and roots that nearly repeat themselves at both ends."""
    rng = random.Random(8)
    a, b = ["a"], ["a", "b"]
    while len(b) < 600:
        a, b = b, b + a
    texts = [b, ["x"] * 500, (["x"] * 30 + ["y"]) * 12]
    for _ in range(150):
        root = []
        for _ in range(rng.randint(1, 4)):
            piece = [rng.choice("ab") for _ in range(rng.randint(1, 5))]
            root += (piece * 9)[:rng.randint(1, 30)]
        texts.append([rng.choice("abc") for _ in range(rng.randint(0, 9))] + (root * 5)[:len(root) * 2 + rng.randint(0, len(root))]
                     + [rng.choice("abc") for _ in range(rng.randint(0, 9))])
    coded = [[w.encode() for w in t] for t in texts]
    assert _search(coded, 12) == [brute(t) for t in texts]


def test_query_equals_brute_force_on_awkward_documents(awkward, spark, scratch):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    more = [(10 ** 6 + i, " ".join(f"w{(i * j) % (7 + i)}" for j in range(i * 3))) for i in range(60)]
    spark.createDataFrame(rows + more, "doc_id long, text string").repartition(3).write.parquet(f"{scratch}/more/documents.parquet")
    short = [(i, t) for i, t in rows + more if len(t or "") < 20_000]
    got = sorted((tuple(r) for r in queries.op13_periodic_runs(spark, f"{scratch}/more").collect()), key=repr)
    want = sorted((digest(i, t) for i, t in short), key=repr)
    assert len(got) == len(rows + more) and set(want) <= set(got)


def test_text_and_runs_of_the_operator(spark):
    df = spark.createDataFrame([(1, "a  b " * 8 + "end", "x"), (2, None, "y"), (None, "one", "z")], "doc_id long, text string, runs string")
    got = {r["doc_id"]: r for r in periodic_runs(df).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 16, 2)] and got[1]["text"] == "a b end" and got[1]["n_words"] == 17
    assert got[2]["runs"] == [] and got[2]["text"] == "" and got[None]["text"] == "one"


def test_no_documents(no_documents):
    assert periodic_runs(no_documents).collect() == []


def test_a_long_document_of_one_word_takes_no_pairs():
    assert _search([[b"w"] * 200_000], 12) == [[(0, 200_000, 1)]]
    assert np.array_equal(_search([[b"u", b"v"] * 50_000], 12), [[(0, 100_000, 2)]])
