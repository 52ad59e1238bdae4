import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgelake.llm import mixing
from lodgelake.llm.mixing import mix, mix_sizes
from lodgelake.llm.sharding import shard_by_bytes
from lodgelake.llm.vector_search import top_k


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, id string, shard string").repartition(3)


def brute_top(rows, k, every):
    usable = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, *_ in rows
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(usable):
        if q % every == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for j, (i, w) in enumerate(usable) if j != at and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 4) / 4], 0, "s", "i", "x") for i in range(200)]  # many ties
    rows += [(7, [0.25] * 4, 0, "", "", ""), (201, None, 0, "", "", ""), (None, [1.0] * 4, 0, "", "", ""), (202, [1.0, None, 0.0, 0.0], 0, "", "", ""),
             (204, [float("nan"), 1.0, 1.0, 1.0], 0, "", "", ""), (206, [float("inf")] * 4, 0, "", "", ""), (208, [1.0, 2.0], 0, "", "", ""),
             (210, [2.0, 2.0], 0, "", "", ""), (212, [], 0, "", "", ""), (214, [1e6] * 4, 0, "", "", "")]
    # rows that repeat an id, with and without its vector: only a query's own row is barred
    rows += [(4, [9.0, 1.0, 0.0, 0.0], 0, "", "", ""), (4, [9.0, 1.0, 0.0, 0.0], 1, "", "", ""), (4, [8.0, 8.0, 0.0, 0.0], 0, "", "", ""), (50, [7.5] * 4, 0, "", "", ""), (50, [7.5] * 4, 0, "", "", "")]
    df = vectors(spark, rows)
    want = brute_top(rows, 5, 2)
    for block, tile in ((8192, 2048), (7, 5)):
        got = top_k(df, df.where("vec_id % 2 = 0"), k=5, block_rows=block, tile_rows=tile, fan_in=2)
        assert sorted(tuple(r) for r in got.collect()) == want


def test_top_k_beyond_float_precision(spark):
    rows = [(i, [float(2 ** 40 + i * 2 ** 20), 3.0], 0, "", "", "") for i in range(6)]
    df = vectors(spark, rows)
    got = sorted(tuple(r) for r in top_k(df, df.where("vec_id = 0"), k=3).collect())
    want = brute_top(rows, 3, 100)
    limit = 2 ** 63 - 1
    assert [(q, i) for q, _, i, _ in want] == [(0, 5), (0, 4), (0, 3)]
    assert [r[3] for r in got] == [min(limit, s) for *_, s in want]


def test_top_k_of_nothing(spark):
    assert top_k(vectors(spark, []), vectors(spark, [])).collect() == []


def test_shards_are_contiguous_and_balanced(awkward):
    rows = awkward.collect()
    got = [r.asDict() for r in shard_by_bytes(awkward, 8, keep=("lang",)).collect()]
    assert len(got) == len(rows)
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())))
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append((r["size"], r["text_crc32"]))
    assert {k: sorted(v) for k, v in by_id.items()} == {k: sorted(v) for k, v in found.items()}
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    total, at = sum(r["size"] for r in got), 0
    for r in got:
        assert r["shard"] == (2 * at + r["size"]) * 8 // (2 * total)
        at += r["size"]
    for k in range(8):
        assert [r["slot"] for r in got if r["shard"] == k] == list(range(sum(r["shard"] == k for r in got)))


def test_no_documents(no_documents):
    assert shard_by_bytes(no_documents).collect() == []
    assert mix_sizes(no_documents).collect() == []
    assert mix(no_documents).collect() == []


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % 3] for k, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while True:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= cap * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            open_.discard(s)
        if not open_:
            return target


@pytest.mark.parametrize("seed", [17, 18])
def test_mix_meets_its_targets(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), ["a", "b", "c", None, "", "d"][int(rng.integers(0, 6)) if i > 8 else 5]) for i in range(3000)]
    rows += [(5000 + i, "w " * 2000, "e") for i in range(3)] + [(6000, None, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = mix_sizes(df, seed=seed).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    want = brute_targets(sizes)
    taken, most = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        base = int(r["target"] // r["source_size"]) if r["source_size"] else 0
        assert base <= r["copies"] <= base + 1
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6
    again = {(r["doc_id"], r["taken"]) for r in mix_sizes(df.repartition(2), seed=seed).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_larger_documents_are_drawn_more_often(spark):
    rows = [(i, "w " * (10 if i % 2 else 40), "a" if i < 2000 else "b") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    drawn = [r for r in mix_sizes(df).collect() if r["source"] == "b"]
    share = {n: np.mean([r["copies"] > 0 for r in drawn if r["size"] == n]) for n in (10, 40)}
    assert share[40] > 2 * share[10]


def test_awkward_documents_are_mixed_with_their_columns(awkward):
    plan = mix_sizes(awkward).collect()
    assert len(plan) == awkward.count()
    mixed = mix(awkward)
    assert mixed.columns == awkward.columns
    assert mixed.count() == sum(r["copies"] for r in plan)


def test_rows_without_or_with_one_id_draw_for_themselves(spark, scratch):
    """Equal rows and rows that share an id meet their source's target as unique ones do."""
    rows = [(None, "w " * 10, "a", "x") for _ in range(3000)] + [(i, "w " * 10, "b", "x") for i in range(3000)]
    rows += [(7, f"{i} " * 10, "c", "x") for i in range(3000)] + [(8, "w " * 10, "d", str(i % 3)) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _c string").repartition(5)
    taken, want = defaultdict(int), {}
    got = mix_sizes(df).collect()
    for r in got:
        taken[r["source"]] += r["taken"]
        want[r["source"]] = r["target"]
    assert len(got) == 12_000 and all(abs(taken[s] - want[s]) <= 5 for s in want) and any(want[s] % 30_000 for s in want)
    mixed = mix(df)
    assert mixed.columns == df.columns
    words = {r["source"]: 10 * r["n"] for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert words == dict(taken)
    assert {r["_c"] for r in mixed.where("source = 'd'").collect()} == {"0", "1", "2"}


def test_many_equal_rows_unfold_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "UNFOLDED", 4)
    df = spark.createDataFrame([(1, "one two", "a")] * 30 + [(2, "x", "b")], "doc_id long, text string, source string")
    assert len(mix_sizes(df).collect()) == 31
    assert mix(df).count() == sum(r["copies"] for r in mix_sizes(df).collect())


def test_certain_sizes_take_linear_time(spark):
    def seconds(n):
        hist = spark.range(1, n + 1, numPartitions=1).select(F.lit("=a").alias("_key"), F.col("id").alias("size"), F.lit(3).cast("long").alias("n"), F.lit(1e9).alias("extra"))
        t = time.time()
        mixing._certain(hist).collect()
        return time.time() - t

    seconds(1000)
    few, many = min(seconds(20_000) for _ in range(2)), min(seconds(160_000) for _ in range(2))
    assert many < 16 * few + 1
