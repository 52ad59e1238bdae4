import hashlib
import random

from lodgelake.llm import line_chunks, queries


def without_runs(texts):
    """What stays when later copies of runs go, found line by line and without the operator's chunks."""
    first, out = {}, []
    for k, text in enumerate(texts):
        lines = text.split("\n")
        filled = [i for i, x in enumerate(lines) if x.strip()]
        gone = set()
        for i, j in zip(filled, filled[1:]):
            at = first.setdefault(tuple(lines[i:j + 1]), (k, i, j))
            if at[0] != k or i > at[2]:
                gone |= set(range(i, j + 1))
        # a removed line takes its line break along
        kept = [x + ("\n" if i < len(lines) - 1 else "") for i, x in enumerate(lines) if i not in gone]
        out.append((len(gone), "".join(kept)))
    return out


def test_short_passages_between_own_lines_go_whole(spark, scratch):
    rng = random.Random(6)
    shared = [[f"passage {k} line {i} {rng.random()}" for i in range(rng.randint(2, 6))] for k in range(40)]
    shared[3].insert(1, "")
    texts = []
    for _ in range(60):
        parts = [[f"own {rng.random()}"] + rng.choice(shared) + [f"own {rng.random()}"] * rng.randint(1, 4) for _ in range(3)]
        texts.append("\n".join(x for p in parts for x in p) + rng.choice(["", "\n", "\n\n  \n"]))
    texts += ["", "a", "same\nsame\nsame\nsame\nsame", "x\nsame\nsame\ny", texts[0], "é\nü", "é\nü\n"]
    spark.createDataFrame(list(enumerate([*texts, None])), "doc_id long, text string").coalesce(1).write.parquet(f"{scratch}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.op6_line_dedup(spark, scratch).collect()}
    want = without_runs([*texts, ""])
    assert [(got[i]["n_removed_lines"], got[i]["kept_sha256"]) for i in range(len(want))] == [(n, hashlib.sha256(t.encode()).hexdigest()) for n, t in want]
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    left = {r["doc_id"]: r["text"] for r in line_chunks.line_dedup(docs).collect()}
    assert [left[i] for i in range(len(want))] == [t for _, t in want]
    # each shared line stays once
    for line in {x for p in shared for x in p if x and any(x in t for t in texts)}:
        assert sum(t.split("\n").count(line) for t in left.values()) == 1
