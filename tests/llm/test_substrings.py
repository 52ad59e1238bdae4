import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodgelake.llm import substring_dedup
from lodgelake.llm.anchors import runs
from lodgelake.llm.suffix_array import permuted_lcp, suffix_array
from lodgelake.llm import suffix_array as sa_module


def brute(texts, length):
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("small", [1, 24, 10 ** 9])
def test_suffix_array_equals_sorting(monkeypatch, small):
    monkeypatch.setattr(sa_module, "SMALL_BUCKETS", small)
    rng = random.Random(small)
    for _ in range(200):
        s = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randint(0, 50))] + [0]
        want = sorted(range(len(s)), key=lambda i: s[i:])
        sa = suffix_array(np.array(s))
        assert sa.tolist() == want
        lcp = permuted_lcp(np.array(s), sa, 9)
        for a, b in zip(want, want[1:]):
            n = 0
            while n < 9 and a + n < len(s) and b + n < len(s) and s[a + n] == s[b + n]:
                n += 1
            assert lcp[b] == n


def test_runs_cover_each_string_once_and_agree_on_equal_strings():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 60))).encode() for _ in range(40)]
    ends = np.append(0, np.cumsum([len(t) for t in texts]))
    key, text, start, n = runs(np.frombuffer(b"".join(texts), dtype=np.uint8), ends, 12, 4)
    found, keys = Counter(), {}
    for k, t, s, c in zip(key, text, start, n):
        for i in range(s, s + c):
            found[t, i] += 1
            assert keys.setdefault(texts[t][i:i + 12], k) == k
    assert found == Counter((t, i) for t, x in enumerate(texts) for i in range(len(x) - 11))


@pytest.mark.parametrize("hot", [4000, 2, 0])
def test_awkward_documents_equal_brute_force(awkward, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_PIECES", hot)  # 0: every anchor with several pieces is hot, down to single strings
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    want = sorted(((i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 200))), key=repr)
    assert sorted((tuple(r) for r in substring_dedup.digest(awkward, 200).collect()), key=repr) == want


@pytest.mark.parametrize("width", [1, 4, 16, 300])
def test_blocks_cover_each_string_once_and_share_their_bytes(width):
    rng, length = random.Random(width), 20
    for _ in range(200):
        anchor, n = rng.randint(0, 40), rng.randint(1, 40)
        found = Counter()
        for k, at, m, first, end in substring_dedup.blocks_of(n, anchor, width, length):
            assert 1 <= m <= width and at >= 0
            assert end - first == length - width + 1 or width > length
            for i in range(at, at + m):
                found[i] += 1
                assert (anchor - i) // width == k
                if first < end:
                    assert i <= first and end <= i + length
        assert found == Counter(range(n))


@pytest.mark.parametrize("hot", [5, 60])
def test_a_passage_quoted_by_every_document_is_split(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_PIECES", hot)
    rng = random.Random(hot)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    passage = " ".join(word() for _ in range(60))
    rows = []
    for i in range(120):  # whole, its beginning or its end, between words of each document; a few endings are shared
        a, b = rng.choice([(0, None), (0, -rng.randint(1, 90)), (rng.randint(1, 90), None)])
        end = rng.choice(["same end of a few", word()])
        rows.append((i, f"{' '.join(word() for _ in range(rng.randint(0, 40)))} {passage[a:b]}{end} {' '.join(word() for _ in range(30))}"))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, *x) for (i, _), x in zip(rows, brute([t for _, t in rows], 200))]
    assert sorted(tuple(r) for r in substring_dedup.digest(docs, 200).collect()) == want


def test_spans_and_kept_bytes(spark, awkward):
    for r in substring_dedup.repeated_spans(awkward, 200).collect():
        assert r["n_bytes"] - sum(s["last"] - s["first"] for s in r["spans"]) == len(r["kept"])


def test_no_documents(no_documents):
    assert substring_dedup.digest(no_documents, 200).collect() == []
