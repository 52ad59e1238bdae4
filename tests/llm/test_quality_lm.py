import math
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from lodgelake.llm import gru, lm_score
from lodgelake.llm.quality import accepted, isotonic, scores

SF = "/root/testdata/sf0.01"


def test_isotonic_is_monotone_and_keeps_means():
    x, y = isotonic(np.arange(6.0), np.array([0.0, 0.4, 0.2, 0.9, 0.8, 1.0]), np.array([1.0, 2, 2, 1, 1, 1]))
    assert (np.diff(y) > 0).all() and (np.diff(x) > 0).all()
    assert y.tolist() == pytest.approx([0.0, 0.3, 0.85, 1.0])


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in got)
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.95
    # labels of held-out rows teach nothing
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 then 1 - quality else quality end as quality")
    assert {(r["doc_id"], r["score"]) for r in scores(docs, other).collect()} == {(r["doc_id"], r["score"]) for r in scores(docs, labels).collect()}


def test_awkward_documents_get_scores(spark, awkward, no_documents):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (3, 1), (3, 0), (None, 1), (14, 1), (19, 0), (4, 1)], "doc_id long, quality int")
    got = scores(awkward, labels).collect()
    assert len(got) == awkward.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    by_text = {}
    for r, d in zip(sorted(got, key=lambda r: repr(r["doc_id"])), sorted(awkward.collect(), key=lambda r: repr(r["doc_id"]))):
        if r["doc_id"] is not None:
            assert by_text.setdefault(d["text"] or "", r["score"]) == r["score"]
    kept = accepted(awkward, labels)
    assert kept.columns == awkward.columns and kept.count() == sum(r["predicted"] for r in got)
    none = labels.where("false")
    assert {r["score"] for r in scores(awkward, none).collect()} == {0.5}
    assert scores(no_documents, labels).collect() == []


def model(rng, n_rare=4):
    layout = gru.Layout(np.array([0, 1, 3, 7]), n_rare)
    p = gru.initial(layout, np.arange(7.0) + 1, np.ones(n_rare))
    return layout, {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in p.items()}


def nll(p, layout, symbols, lengths):
    return -gru.text_scores(p, layout, symbols, lengths).sum() / len(symbols)


def test_probabilities_sum_to_one():
    layout, p = model(np.random.default_rng(0))
    states = np.random.default_rng(1).normal(size=(1, gru.STATE))
    every = np.arange(layout.n_symbols)
    logp = gru.log_probability(p, layout, layout.class_of(), np.repeat(states, len(every), axis=0), every)
    assert np.exp(logp).sum() == pytest.approx(1.0)


def test_gradients_equal_finite_differences(monkeypatch):
    rng = np.random.default_rng(2)
    layout, p = model(rng)
    lengths = np.array([5, 3, 4])
    symbols = np.array([3, 4, 8, 1, 0, 2, 9, 0, 5, 6, 7, 0])
    seen = {}
    monkeypatch.setattr(gru, "_update", lambda p, squares, grad: seen.update(grad))
    gru.train(p, layout, symbols, lengths)
    ids, rows = seen["P"]
    dense = np.zeros_like(p["P"])
    dense[ids] = rows
    for k, g in {**seen, "P": dense}.items():
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in p[k].shape)
            up, down = {**p, k: p[k].copy()}, {**p, k: p[k].copy()}
            up[k][at] += 1e-5
            down[k][at] -= 1e-5
            want = (nll(up, layout, symbols, lengths) - nll(down, layout, symbols, lengths)) / 2e-5
            assert g[at] == pytest.approx(want, abs=1e-6)


def test_state_is_carried_over_windows_and_texts_do_not_mix(monkeypatch):
    rng = np.random.default_rng(3)
    layout, p = model(rng)
    texts = [np.append(rng.integers(1, layout.n_symbols, n), 0) for n in (0, 1, 70, 7, 300)]
    lengths = np.array([len(t) for t in texts])
    whole = gru.text_scores(p, layout, np.concatenate(texts), lengths)
    monkeypatch.setattr(gru, "LANES", 2)
    monkeypatch.setattr(gru, "WINDOW", 5)
    for t, got, few in zip(texts, whole, gru.text_scores(p, layout, np.concatenate(texts), lengths)):
        h, total, before = np.zeros((1, gru.STATE)), 0.0, 0
        for s in t:
            h, _ = gru.step(p, (p["P"] + p["b"])[[before]], h)
            total += gru.log_probability(p, layout, layout.class_of(), h, np.array([s]))[0]
            before = s
        assert got == pytest.approx(total, rel=1e-4) and few == pytest.approx(total, rel=1e-4)


def check_base(rows, texts):
    tokens = {i: t.encode().lower().split() + [b""] for i, t in texts}
    held = {i: i is None or zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in texts}
    c = Counter(w for i, _ in texts if not held[i] for w in tokens[i])
    n, v = sum(c.values()), len(c)
    for r in rows:
        t = tokens[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(t), sum(c[w] > 0 for w in t), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t))


def test_held_out_texts_score_above_their_counts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(lm_score, "HEAD", 3000)  # most tokens meet their counts in the join
    rows = lm_score.scores(docs).collect()
    check_base(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_awkward_documents_are_scored(awkward, no_documents):
    distinct = awkward.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = lm_score.scores(distinct).collect()
    check_base(rows, [(r["doc_id"], r["text"] or "") for r in distinct.collect()])
    assert all(np.isfinite(r["score"]) and r["score"] <= 0 for r in rows)
    assert len(lm_score.scores(awkward).collect()) == awkward.count()
    assert lm_score.scores(no_documents).collect() == []


def test_great_weights_give_finite_scores_and_the_same_steps():
    rng = np.random.default_rng(6)
    layout, p = model(rng)
    p |= {"W": p["W"] * 400, "w": p["w"] + 300, "C": p["C"] * 400}
    assert not gru.Output(p).small and gru.Output(model(rng)[1]).small
    lengths = np.array([30, 1, 9])
    symbols = rng.integers(1, layout.n_symbols, lengths.sum())
    symbols[np.cumsum(lengths) - 1] = 0
    assert np.isfinite(gru.text_scores(p, layout, symbols, lengths)).all()
    trained = gru.train(p, layout, symbols, lengths)
    assert all(np.isfinite(v).all() for v in trained.values())
    # a number added to all words of a group changes no probability
    moved = {**p, "w": p["w"] - 300}
    assert gru.text_scores(moved, layout, symbols, lengths) == pytest.approx(gru.text_scores(p, layout, symbols, lengths))


def test_tokens_hold_no_numbers_per_byte():
    texts = pa.array([b"word%d of a Text " % i * 50 for i in range(5000)], pa.binary())
    size = pc.sum(pc.binary_length(texts)).as_py()
    tracemalloc.start()
    found = lm_score.Tokens(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.counts.tolist() == [200] * 5000
    assert peak < 20 * size


def test_words_are_found_in_the_head():
    class Head:
        tokens, frequent, layout = pa.array([b"b", b"a", b"unseen", b"c"], pa.binary()), 2, gru.Layout(np.array([0, 1, 3]), lm_score.N_RARE)

    found = lm_score.Tokens(pa.array([b"A x b", None, b"c a a\xc3\xa9"], pa.binary()))
    symbols, place = lm_score.Vocabulary.symbols(Head, found)
    assert place.tolist() == [1, -1, 0, 3, 1, -1]
    rare = [3 + lm_score.rare_class(w) for w in (b"x", b"c", b"a\xc3\xa9")]
    assert symbols.tolist() == [2, rare[0], 1, rare[1], 2, rare[2]]


def test_long_texts_go_on_beside_the_next_slice(monkeypatch):
    rng = np.random.default_rng(8)
    layout, p = model(rng)
    monkeypatch.setattr(gru, "LANES", 8)
    monkeypatch.setattr(gru, "WINDOW", 4)
    texts = [np.append(rng.integers(1, layout.n_symbols, n), 0) for _ in range(6) for n in (200, *range(40))]
    lengths = np.array([len(t) for t in texts])
    want = gru.text_scores(p, layout, np.concatenate(texts), lengths)
    steps, advance = [], gru._advance
    monkeypatch.setattr(gru, "_advance", lambda *a: steps.append(1) or advance(*a))
    per_slice = [gru.text_scores(p, layout, np.concatenate(texts[i:i + 41]), lengths[i:i + 41]) for i in range(0, len(texts), 41)]
    alone, scorer, found = len(steps), gru.Scorer(p, layout), {}
    for i in range(0, len(texts), 41):
        ended = scorer.add(np.concatenate(texts[i:i + 41]), lengths[i:i + 41], range(i, i + 41))
        assert not ended.keys() & found.keys()
        found |= ended
        assert len(found) + len(scorer.waiting) == i + 41
    found |= scorer.add(np.zeros(0, np.int64), np.zeros(0, np.int64), [], last=True)
    assert [found[i] for i in range(len(texts))] == pytest.approx(want.tolist())
    assert np.concatenate(per_slice) == pytest.approx(want)
    assert len(steps) - alone < 0.8 * alone
    assert scorer.waiting == [] and scorer.add(np.zeros(0, np.int64), np.zeros(0, np.int64), [], last=True) == {}


def test_slices_of_texts_are_of_about_one_size(monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE_TOKENS", 100)
    for total in (1, 50, 101, 149, 151, 260, 1010):
        lengths = np.ones(total, dtype=np.int64)
        sizes = [len(s) for s, _ in lm_score.text_slices(np.arange(total), lengths)]
        assert sum(sizes) == total and max(sizes) <= 150 and (len(sizes) == 1 or min(sizes) >= 66)
    assert list(lm_score.text_slices(np.zeros(0, np.int64), np.zeros(0, np.int64))) == []


def test_a_task_counts_a_token_once(monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 8)
    texts = ["a b A c", None, "b d", "", "e f g h i", "a é"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()).cast(pa.binary())], names=["t"])
    want = {b"": 6, b"a": 3, b"b": 2, b"c": 1, b"d": 1, b"e": 1, b"f": 1, b"g": 1, b"h": 1, b"i": 1, "é".encode(): 1}
    rows = [r for b in lm_score.partial_counts(iter([batch])) for r in b.to_pylist()]
    assert {r["token"]: r["c"] for r in rows} == want and len(rows) == len(want)
    monkeypatch.setattr(lm_score, "PARTIAL", 3)
    monkeypatch.setattr(lm_score, "COUNTS", 2)
    total = Counter()
    for b in lm_score.partial_counts(iter([batch])):
        assert b.num_rows <= 2
        for r in b.to_pylist():
            total[r["token"]] += r["c"]
    assert total == want


def test_rows_keep_their_numbers_when_texts_wait(monkeypatch):
    class Counts:
        tokens, c, end = pa.array([b"a", b"b", b"c", b"d"], pa.binary()), np.array([9, 7, 3, 2]), 5
        frequent, layout = 2, gru.Layout(np.array([0, 1, 3]), lm_score.N_RARE)
        rare_n, rare_v = np.full(lm_score.N_RARE, 2.0), np.full(lm_score.N_RARE, 1.0)
        symbols = lm_score.Vocabulary.symbols

    rng = np.random.default_rng(9)
    p = gru.initial(Counts.layout, np.array([5.0, 9, 7]), Counts.rare_n)
    texts = [" ".join(rng.choice(["a", "b", "c", "x", "yé"], n)) for n in (300, 3, 0, 5, 400, 2, 1, 9, 350, 8)]
    ids = [7, 7, None, 3, 1, 2, 9, 8, 6, 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(ids[i:j], pa.int64()), pa.array(texts[i:j]).cast(pa.binary())], names=["doc_id", "t"])
               for i, j in ((0, 4), (4, 6), (6, 10))]
    got = sorted((r for b in lm_score.scored(iter(batches), 40, Counts(), p) for r in b.to_pylist()), key=lambda r: r["row"])
    assert [(r["row"], r["doc_id"], r["n_tokens"]) for r in got] == [(40 + i, ids[i], len(t.split()) + 1) for i, t in enumerate(texts)]
    for r, t in zip(got, texts):
        alone = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([t]).cast(pa.binary())], names=["doc_id", "t"])
        one, = [x for b in lm_score.scored(iter([alone]), 0, Counts(), p) for x in b.to_pylist()]
        assert r["model"] == pytest.approx(one["model"], rel=1e-5) and r["tail"] == one["tail"]
        assert (r["known"], r["log_head"]) == (one["known"], pytest.approx(one["log_head"]))
    seen, add = [], gru.Scorer.add
    monkeypatch.setattr(gru.Scorer, "add", lambda self, *a, **k: [seen.append(len(self.waiting)), add(self, *a, **k)][1])
    list(lm_score.scored(iter(batches), 40, Counts(), p))
    assert max(seen) > 0  # some did wait
