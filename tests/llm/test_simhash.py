import random
import re

import numpy as np
import pytest
import xxhash

from lodgelake.llm import simhash
from lodgelake.llm.simhash import SubtrieJoin, components, keep_first, links_of_bands, near_duplicates


def fingerprint(text, width=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints, distance=3):
    """Index of the least member of each row's component."""
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return root


def clustered(rng, n):
    """Fingerprints in chains and clusters around a few centres."""
    out = set()
    while len(out) < n:
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 25)):
            out.add(x)
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
    return sorted(out)[:n]


def test_subtrie_join_equals_all_pairs():
    rng = random.Random(4)
    for _ in range(20):
        keys = np.array(clustered(rng, 120), dtype=np.uint64)
        node, rest = keys >> np.uint64(60), keys & np.uint64((1 << 60) - 1)
        labels = SubtrieJoin(node, rest, 60, 3).run()
        want = brute([int(r) if k == 0 else int(r) | int(k) << 300 for k, r in zip(node, rest)])
        want = [w for w in want]
        # different nodes never link: put them far apart
        far = [int(r) | ((1 << 4 * int(k) + 4) - 1) << 60 for k, r in zip(node, rest)]
        assert labels.tolist() == brute(far)


@pytest.mark.parametrize("hot", [100_000, 2])
def test_links_span_components(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_NODE", hot)  # 2: most nodes with pairs are dealt once more
    rng = random.Random(5)
    prints = clustered(rng, 400)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components(links_of_bands(spark.createDataFrame([(p,) for p in signed], "fp long"), 3)).collect()
    roots = {r["node"]: r["root"] for r in found}
    groups, want = {}, {}
    for p, w in zip(signed, brute(prints)):
        groups.setdefault(roots.get(p, p), set()).add(p)
        want.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_awkward_documents_equal_brute_force(awkward):
    rows = awkward.collect()
    prints = [fingerprint(r["text"]) for r in rows]
    roots = brute(prints)
    least = {}
    for r, c in zip(rows, roots):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    want = sorted(((r["doc_id"], p, least.get(c)) for r, p, c in zip(rows, prints, roots)), key=repr)
    got = sorted(((r["doc_id"], r["fp"] % 2 ** 64, r["component_id"]) for r in near_duplicates(awkward).collect()), key=repr)
    assert got == want
    kept = keep_first(awkward)
    assert kept.columns == awkward.columns
    assert kept.count() == len(set(roots))


def test_no_documents(no_documents):
    assert near_duplicates(no_documents).collect() == []
