import hashlib
import random

import pytest

from lodgelake.llm import queries, window_dedup

ASCII_WHITE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in ASCII_WHITE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def brute(rows, width):
    """Every window of every document against the least id that holds it; ids that are null come last."""
    key = lambda i: (i is None, i)
    least = {}
    for i, text in rows:
        w = words_of(text)
        for a in range(len(w) - width + 1):
            x = tuple(w[a:a + width])
            least[x] = min(least.get(x, key(i)), key(i))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = set()
        for a in range(len(w) - width + 1):
            if least[tuple(w[a:a + width])] < key(i):
                gone |= set(range(a, a + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def digest(df):
    rows = []
    for r in df.collect():
        rows.append((r["doc_id"], r["n_words"], sum(s["last"] - s["first"] for s in r["spans"]), hashlib.sha256(r["text"].encode()).hexdigest()))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("width", [1, 5, 20, 50])
def test_awkward_documents_equal_brute_force(awkward, width):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert digest(window_dedup.without_repeats(awkward, width)) == brute(rows, width)


def test_shared_passages_near_copies_and_equal_ids(spark, scratch):
    rng = random.Random(4)
    passages = [[f"p{k}w{rng.randint(0, 60)}" for _ in range(rng.randint(45, 140))] for k in range(6)]
    rows = []
    for i in range(160):
        words = [f"own{rng.randint(0, 500)}" for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            words += rng.choice(passages) + [f"own{rng.randint(0, 500)}" for _ in range(rng.randint(0, 5))]
        if rng.random() < 0.3 and words:
            words[rng.randrange(len(words))] = "edit"
        rows.append((rng.choice([i, i, 7, None]), " ".join(words)))
    rows += [(i, rows[3][1]) for i in range(300, 340)] + [(500, "same " * 400), (501, "same " * 90), (501, "same " * 49)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(f"{scratch}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op12_substring_dedup(spark, scratch).collect()), key=repr)
    assert got == brute(rows, 50)


def test_rows_are_named_alike_however_the_scan_is_cut(spark, scratch):
    rng = random.Random(5)
    shared = " ".join(f"s{i}" for i in range(80))
    rows = [(i, f"a{rng.random()} b c {shared} d{i} " * rng.randint(1, 3)) for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.option("parquet.block.size", "4096").parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    whole = digest(window_dedup.without_repeats(docs, 50))
    parts = docs.rdd.getNumPartitions()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        again = spark.read.parquet(f"{scratch}/documents.parquet")
        assert again.rdd.getNumPartitions() > parts
        cut = digest(window_dedup.without_repeats(again, 50))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert cut == whole == brute(rows, 50)


def test_no_documents(no_documents):
    assert window_dedup.without_repeats(no_documents, 50).collect() == []
