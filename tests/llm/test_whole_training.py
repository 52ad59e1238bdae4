from collections import Counter

import numpy as np
import pyarrow as pa

from lodgelake.llm import gru, lm_score


def test_every_token_of_training_texts_is_trained_on_once(spark, scratch):
    texts = [(i, " ".join(f"w{(i * 31 + k * k) % 40}" for k in range(n))) for i, n in enumerate([0, 1, 63, 64, 65, 511, 513, 700, 1500, 5000, 90, 90])]
    spark.createDataFrame([*texts, texts[9], (50, None)], "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    training = spark.read.parquet(f"{scratch}/documents.parquet").selectExpr("doc_id", "cast(text as binary) as t")
    vocabulary = lm_score.Vocabulary(lm_score.token_counts(training))
    sent = spark.sparkContext.broadcast(vocabulary)
    rows = lm_score.training_texts(training, sent).collect()
    want = []
    for _, t in [*texts, texts[9], (50, "")]:
        found = lm_score.Tokens(pa.array([t.encode()]))
        want.append((*vocabulary.symbols(found)[0].tolist(), 0))
    assert Counter(tuple(r["symbols"]) for r in rows) == Counter(want)
    assert {r["round"] for r in rows} == set(range(lm_score.ROUNDS))


def test_batches_are_cut_between_texts(monkeypatch):
    monkeypatch.setattr(lm_score, "SLICE_TOKENS", 7)
    texts = [[1, 2, 0], [0], list(range(1, 30)) + [0], [5, 0], [6, 0], [7, 0]]
    batch = pa.RecordBatch.from_arrays([pa.array([[9, 9], *texts, [8, 0]], pa.list_(pa.int32())).slice(1, len(texts))], names=["symbols"])
    got = [t.tolist() for symbols, lengths in lm_score.whole_texts(iter([batch])) for t in np.split(symbols, np.cumsum(lengths)[:-1])]
    assert got == texts


def test_training_carries_the_state_over_windows(monkeypatch):
    rng = np.random.default_rng(4)
    layout = gru.Layout(np.array([0, 1, 3, 7]), 4)
    p = {k: v.astype(np.float64) for k, v in gru.initial(layout, np.arange(7.0) + 1, np.ones(4)).items()}
    texts = [np.append(rng.integers(1, layout.n_symbols, n), 0) for n in (70, 3, 25, 0)]
    monkeypatch.setattr(gru, "TRAIN_LANES", 2)
    monkeypatch.setattr(gru, "TRAIN_WINDOW", 8)
    monkeypatch.setattr(gru, "_update", lambda p, squares, grad: None)
    seen = []
    monkeypatch.setattr(gru, "_gradients", lambda p, layout, class_of, tape, states, targets: seen.append((np.concatenate(states), targets)))
    gru.train(p, layout, np.concatenate(texts), np.array([len(t) for t in texts]))
    got = sorted((s, *h.round(4)) for states, targets in seen for s, h in zip(targets.tolist(), states))
    want = []
    for t in texts:
        h, before = np.zeros((1, gru.STATE)), 0
        for s in t.tolist():
            h, _ = gru.step(p, (p["P"] + p["b"])[[before]], h)
            want.append((s, *h[0].round(4)))
            before = s
    assert np.allclose(np.array(got), np.array(sorted(want)), atol=3e-4)
