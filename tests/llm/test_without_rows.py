import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_decontamination import ITEMS, items
from test_simhash import brute, fingerprint

from lodgelake.llm import lookups
from lodgelake.llm.decontaminate import clean_rows
from lodgelake.llm.simhash import keep_first


@pytest.fixture()
def cut_anew(spark, monkeypatch):
    """Every later scan cuts the files in another way than the one before."""
    before, sizes = lookups.lay_out, iter(["300", "128m", "700"] * 10)

    def lay_out(*args):
        path = before(*args)
        spark.conf.set("spark.sql.files.maxPartitionBytes", next(sizes))
        spark.conf.set("spark.sql.files.minPartitionNum", "13")
        return path

    monkeypatch.setattr(lookups, "lay_out", lay_out)
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.minPartitionNum")


def rows_of(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_rows_that_go_do_not_depend_on_how_files_are_cut(spark, awkward, cut_anew):
    named = awkward.select(lookups.row_name(awkward).alias("row"), lookups.text_size().alias("size"), "doc_id", "text")
    gone = named.where("doc_id % 3 = 0 or doc_id is null")
    assert rows_of(lookups.without_rows(awkward, gone)) == rows_of(awkward.where("doc_id % 3 <> 0"))
    assert rows_of(lookups.without_rows(awkward, gone.where("false"))) == rows_of(awkward)
    assert rows_of(lookups.without_rows(awkward, named)) == []


def test_stages_do_not_depend_on_how_files_are_cut(spark, awkward, cut_anew):
    kept = keep_first(awkward).collect()
    assert len(kept) == len(set(brute([fingerprint(r["text"]) for r in awkward.collect()])))
    bad = ITEMS[1][1]
    clean = clean_rows(awkward, items(spark)).collect()
    assert bad not in {r["text"] for r in clean} and clean


def test_texts_are_not_shuffled(spark, awkward):
    for kept in (keep_first(awkward), clean_rows(awkward, items(spark))):
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and "MapInArrow" in plan


def test_a_replaced_text_fails(spark, awkward):
    named = awkward.select(lookups.row_name(awkward).alias("row"), (lookups.text_size() + 1).alias("size"), "doc_id")
    with pytest.raises(Exception, match="replaced between two scans"):
        lookups.without_rows(awkward, named).collect()


def test_stages_keep_column_types(spark, tmp_path):
    df = spark.createDataFrame([(1, "a text of some words", [1, 2], {"k": 1.5}, None)], "doc_id int, text string, row array<int>, `a.b` map<string,double>, t binary")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.schema == docs.schema and kept.collect() == docs.collect()
    assert kept.select(F.col("`a.b`")["k"]).first()[0] == 1.5
