import corpus_pipeline
from test_decontamination import ITEMS, brute, items


def test_a_clean_row_stays_beside_a_contaminated_one_of_its_id(spark, tmp_path):
    bad = ITEMS[1][1]
    rows = [(None, bad), (None, "a clean text without an id"), (None, None), (7, bad), (7, "a clean text of a repeated id"), (8, bad), (9, "a clean text"),
            (9, "a clean text")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(r) for r in rows if r[1] != bad)


def test_awkward_rows_are_judged_one_by_one(spark, awkward, tmp_path):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.decontamination(spark, awkward, str(tmp_path))
    assert kept.columns == awkward.columns
    rows = awkward.collect()
    want = [r for r in rows if not brute(r["text"])[3]]
    assert any(r["doc_id"] is None for r in want) and len(want) < len(rows)
    assert sorted(repr(tuple(r)) for r in kept.collect()) == sorted(repr(tuple(r)) for r in want)
