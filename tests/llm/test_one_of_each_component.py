import corpus_pipeline
from test_simhash import brute, fingerprint


def first_rows(rows):
    """The first row of each component by (id, nulls last, place)."""
    least = {}
    for i, (r, c) in enumerate(zip(rows, brute([fingerprint(r["text"]) for r in rows]))):
        key = (r["doc_id"] is None, r["doc_id"] or 0, i)
        least[c] = min(least.get(c, key), key)
    return sorted(repr(tuple(rows[i])) for _, _, i in least.values())


def test_null_and_repeated_ids_leave_one_row_of_each_component(spark, tmp_path):
    texts = [" ".join(f"t{k}w{i * i % 57}" for i in range(30)) for k in range(5)]
    rows = [(None, texts[0]), (None, texts[0]), (None, texts[0]),  # copies without an id
            (1, texts[1]), (1, texts[1]), (2, texts[1]),  # the kept id repeated
            (0, texts[2]), (1, texts[2]),  # the root of another component
            (3, texts[3]), (None, texts[3]), (None, None), (4, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [(None, texts[0]), (1, texts[1]), (0, texts[2]), (3, texts[3]), (4, "")]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_awkward_rows_leave_one_of_each_component(spark, awkward):
    kept = corpus_pipeline.near_duplicates(spark, awkward, "")
    assert kept.columns == awkward.columns
    assert sorted(repr(tuple(r)) for r in kept.collect()) == first_rows(awkward.collect())
