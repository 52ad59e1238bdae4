import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lodgelake.llm import line_chunks
from lodgelake.llm.line_chunks import chunk_bytes, chunks
from lodgelake.llm.token_files import PieceEncoder, TokenFile, read_documents, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_pieces_give_the_ids_of_the_whole_text(tokenizer):
    rng = random.Random(1)
    parts = ["a", "Ab", "é", "ñandu", "漢", " ", "  ", "\n", "\t", "\r\n", "\x1c", "'s", "'", "''", "'t", "12", "½", ".", ",", "!", "&&&", "|", "_",
             "<|endoftext|>", "😀", "\x85", " ", "\xa0", "\0", "﻿"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(20_000)]
    ids, starts = PieceEncoder(PATH).encode(pa.array(texts))
    for k, e in enumerate(tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[starts[k]:starts[k + 1]].tolist() == e.ids, texts[k]


def test_files_round_trip(spark, awkward, tokenizer):
    files = write_token_files(awkward, PATH, end_id=0, seq_len=64)
    got = sorted(read_documents(spark, files).collect(), key=lambda r: r["start"])
    rows = sorted(((r["doc_id"], r["text"]) for r in awkward.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, everything = 0, []
    for r, (doc_id, text) in zip(got, rows, strict=True):
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert tuple(r) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
        everything.append(ids)
    flat, seen = np.concatenate(everything), []
    for f in files:
        file = TokenFile(f["name"])
        for i in range(-(-f["n_tokens"] // 64)):
            ids, mask = file.sequence(i)
            assert len(ids) == len(mask) == 64 and ids.base is not None  # a view of the file's buffer
            seen.append(ids[mask])
    assert np.array_equal(np.concatenate(seen), flat)


def test_rows_without_an_id_are_dealt_over_files(spark, tokenizer):
    texts = [f"{k * 7919 % 1000} words of text {k}" for k in range(400)]
    docs = spark.createDataFrame([(None, t) for t in texts] + [(5, t) for t in texts], "doc_id long, text string")
    files = write_token_files(docs, PATH, seq_len=64)
    assert len(files) > 2 and max(f["n_docs"] for f in files) < 400
    got = sorted(read_documents(spark, files).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None] * 400 + [5] * 400
    ids = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], dtype="<u4") for t in sorted(texts)] * 2
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(x.tobytes()) for x in ids]
    assert [r["start"] for r in got] == [0, *np.cumsum([len(x) for x in ids])[:-1].tolist()]


def test_no_files_of_no_documents(spark, no_documents):
    assert read_documents(spark, write_token_files(no_documents, PATH)).collect() == []


def test_chunks_hold_every_pair_of_lines_and_resist_shifts():
    rng = random.Random(3)
    block = [f"line {rng.random()}" + "\n" * (rng.random() < 0.2) for _ in range(300)]
    one = "\n".join(["x", *block, "y"]).encode()
    two = "\n".join(["some", "other", "lines", "first", *block]).encode()
    cut = [[(chunk_bytes(t, a, b), filled) for a, b, _, filled in chunks(t)] for t in (one, two)]
    whole = [{c for c, filled in x if filled > 2} for x in cut]
    assert len(whole[0]) > 30 and len(whole[0] & whole[1]) >= len(whole[0]) - 2  # chunks by rolling hash, the same after a shift
    for t in (one, two):
        lines = [x for x in t.split(b"\n") if x.strip()]
        spans = chunks(t)
        at = [t.index(x) for x in lines]
        assert all(any(a <= i and b >= j + len(y) for a, b, _, _ in spans) for i, j, y in zip(at, at[1:], lines[1:]))


def test_awkward_lines(awkward, no_documents):
    got = line_chunks.digest(awkward).collect()
    assert len(got) == awkward.count()
    assert line_chunks.digest(no_documents).collect() == []


def test_pipeline_stages_keep_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == docs.columns
        counts.append(after.count())
        docs = after
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5] > 0
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    first = {r["doc_id"] for r in spark.read.parquet(f"{tmp_path}/0").select("doc_id").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in first for i in good) > 0.95 * len(good)
    # the whole run gives the same rows
    run = corpus_pipeline.run(spark, SF).select("doc_id", "shard", "slot").collect()
    assert sorted(map(tuple, run)) == sorted(tuple(r) for r in docs.select("doc_id", "shard", "slot").collect())


def test_pipeline_stages_of_no_documents(spark, no_documents):
    docs = no_documents
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == [], name
        if name != "sharding":
            assert out.columns == docs.columns
