import itertools
import random
import re
from collections import Counter
from zlib import crc32

import pytest

from lodgelake.llm import queries, spelling

UPPER = {c: chr(c + 32) for c in range(65, 91)}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        others = sorted((-m, x) for x, m in counts.items() if x != w and near(w, x))
        form = others[0] if others and -others[0][0] >= ratio * n else None
        out[w] = (form and form[1], n, len(others), form and -form[0])
    rows = []
    for w, (form, n, k, m) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, k, m))
    return sorted(rows)


def brute_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = crc32(f"{i}:{run}".encode())
            if i is not None and h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def some_words(rng, letters, many):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(many)}
    for w in list(words):
        i = rng.randint(0, len(w))
        words |= {w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:]}
    return {w: rng.choice([1, 1, 2, 5, 9, 50, 300, 2000]) for w in words if w}


@pytest.mark.parametrize("letters, room", [("ab", None), ("abcäÿ", None), ("abcdefgh", 4)])
def test_variants_equal_brute_force(spark, monkeypatch, letters, room):
    if room:  # blocks of filter to a round: several rounds
        monkeypatch.setattr(spelling, "FILTER_BYTES", room * spelling.BLOCK)
    counts = some_words(random.Random(len(letters)), letters, 150)
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == brute_variants(counts)


def test_long_words_are_edited_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PROBES", 64)
    a = "ab" * 300
    counts = {a: 100, a[:77] + a[78:]: 7, a[:200] + "z" + a[201:]: 3, a + "b": 1, "z": 1}
    df = spark.createDataFrame(sorted(counts.items()), "word string, n long")
    assert sorted(tuple(r) for r in spelling.variants(df).collect()) == brute_variants(counts)


def test_every_edit_is_made_once():
    import numpy as np
    alphabet = np.frombuffer(b"abc", dtype=np.uint8)
    words = ["".join(x) for x in itertools.product("abc", repeat=4)]
    made = Counter()
    for _, at, matrix in spelling._by_length(words):
        for length, sums, w, place, letter in spelling._edits(matrix, alphabet):
            for k, x, p, c in zip(sums.tolist(), w.tolist(), place.tolist(), letter.tolist()):
                new = spelling._edited(matrix[x].tobytes(), p, c)
                assert len(new) == length
                assert k == int(spelling.word_sums(np.frombuffer(new.encode("latin-1"), dtype=np.uint8)[None, :])[0])
                made[words[at[x]], new] += 1
    want = {(w, x) for w in words for x in words if near(w, x) and x > w} | {(w, w[:i] + w[i + 1:]) for w in words for i in range(4)}
    assert set(made) == want and set(made.values()) == {1}


def test_query_equals_brute_force(awkward, spark, scratch):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    rng = random.Random(3)
    lexicon = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(40)] + ["À×÷ABCdef", "ABCdef"]
    rows += [(1000 + i, " ".join(rng.choice(lexicon) for _ in range(60))) for i in range(150)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{scratch}/more/documents.parquet")
    got = sorted(tuple(r) for r in queries.op11_spelling(spark, f"{scratch}/more").collect())
    want = brute_variants(brute_words(rows))
    assert got == want and any(r[1] for r in want)


def test_no_words(spark, no_documents):
    words = spelling.vocabulary(no_documents)
    assert spelling.variants(words).collect() == []
