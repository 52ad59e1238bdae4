import re

from lodgelake.llm import decontaminate
from lodgelake.llm.decontaminate import clean_rows, contamination, find_items

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [(1, "shared0 passage0 shared1"), (2, " ".join(f"shared{i} passage{i}" for i in range(5, 15))), (2, "one two"), (10, None),
         (11, "..."), (None, "lazy dog"), (12, "nowhere to be found"), (13, "the the")]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, window=13):
    w, hit, ids = words(text), set(), set()
    for item, t in ITEMS:
        v = words(t)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit |= set(range(j, j + n))
                    if item is not None:
                        ids.add(str(item))
    return len(w), len(hit), tuple(sorted(ids)), bool(hit) and 20 * len(hit) >= len(w)


def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def result(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in df.collect()), key=repr)


def test_awkward_documents_equal_brute_force(spark, awkward, monkeypatch):
    want = sorted(((r["doc_id"], *brute(r["text"])) for r in awkward.collect()), key=repr)
    assert result(contamination(awkward, items(spark))) == want
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 4)  # many passes, items cut across blocks
    assert result(contamination(awkward, items(spark))) == want


def test_clean_keeps_clean_rows_and_their_columns(spark, awkward):
    kept = clean_rows(awkward, items(spark))
    assert kept.columns == awkward.columns
    want = sorted(repr(tuple(r)) for r in awkward.collect() if not brute(r["text"])[3])
    assert sorted(repr(tuple(r)) for r in kept.collect()) == want


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta x gamma"), (2, "gamma beta alpha"), (3, "alpha beta"), (4, "alpha x x x x x x beta gamma")],
                                 "doc_id long, text string")
    tests = spark.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    near = {r["doc_id"]: list(r["items"]) for r in find_items(docs, tests, reach=5).collect()}
    assert near == {1: ["7"], 2: ["7"], 3: [], 4: []}


def test_empty_tables(spark, awkward, no_documents):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination(no_documents, items(spark)).collect() == []
    assert not any(r["contaminated"] for r in contamination(awkward, none).collect())
    assert clean_rows(awkward, none).count() == awkward.count()
