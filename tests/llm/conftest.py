import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; extra columns may have any of them.
CLASHING = ["row", "key", "fp", "size", "_key", "n", "spans", "score", "stats", "t", "copies", "shard", "slot", "base", "_id", "a"]

PASSAGE = " ".join(f"shared{i} passage{i}" for i in range(40))


def awkward_rows():
    long_text = " ".join(f"w{i % 997} x{i * 7 % 89}." for i in range(20_000))
    texts = [
        None, "", " \n\t ", "one", "One TWO", "a\nb\nc\nd", PASSAGE, "start words " + PASSAGE + " end words", "é" * 150 + PASSAGE + "ü",
        long_text, "z" * 1000, "ab" * 600, "line one\nline two\nline three\n\nline four\n" * 3, "line one\nline two\nline three\n\nline four",
        "The quick brown fox jumps over the lazy dog and runs far away from it all today", "The quick brown fox jumps over the lazy dog and runs far away from it all today.",
        "\x00\x1c odd \x85 bytes ﻿ 😀", "<|endoftext|> is text", "the the the the the the", "| a | b | c ### ***",
    ]
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[7], rows[7], (None, PASSAGE, None, None, None), (None, "without an id", "de", "", 3), (100, PASSAGE, "fr", "s1", 1), (101, PASSAGE, "fr", "s1", 1)]
    return rows


@pytest.fixture()
def awkward(spark, scratch):
    """A table of awkward documents, read from files, with extra columns of clashing names."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)
    df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
    df.write.parquet(f"{scratch}/documents.parquet")
    return spark.read.parquet(f"{scratch}/documents.parquet")


@pytest.fixture()
def no_documents(spark, scratch):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{scratch}/none.parquet")
    return spark.read.parquet(f"{scratch}/none.parquet")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
