"""SimHash near-duplicates: fingerprints, binary-trie self-join, connected components.

Fingerprints.  A text's words (ASCII letters in lower case, cut at ASCII white space) give shingles of
``width`` words joined by a blank; a shorter text is one shingle, a text without words has fingerprint
0.  A bit is 1 if it is set in more than half of the shingles' XXH64 values (seed 42).  Equal
fingerprints are one class, so copies never meet one another again.

Trie self-join.  Two fingerprints within ``distance`` bits agree in at least one of ``distance + 1``
equal bands, so each band in turn is put at the top of the trie: below a node of those top bits the
budget is still whole, and only such nodes are paired with themselves.  Every class goes to its node
of each band.  A node of more than ``HOT_NODE`` classes (many near copies of one text) is dealt once more
in the same way, by bands of its remaining bits, so its classes spread over many tasks.  A task walks the subtries of its nodes level by level with pairs of subtries: both
children of a pair are paired, a differing bit costs one of the budget, and a pair is dropped when the
budget is spent or when all that hangs below it is already one component.  The walk runs with budgets
1, 2, ... so that dense groups of near copies have joined before the wide budgets start; a task gives
back a star per component (fewer links than classes), never a group's pairs.  Pairs waiting to be
walked are kept in blocks on a stack, which bounds memory for any group.

Components come from alternating large-star and small-star steps over those links, each written to
shared storage.

Defined cases: null text is empty text; empty and wordless texts have fingerprint 0 and link like any
other; a null id is kept and never names a component that has another id; repeated rows are kept, one
row each; an empty table gives no rows.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm.common import shuffle_parts, written
from lodgelake.llm.lookups import row_name, text_size, without_rows

#: Shingles whose bits are counted at once.
SLICE_SHINGLES = 100_000
#: Pairs of subtries walked at once, and links held before they are merged into components.
PAIR_BLOCK, LINK_BLOCK = 500_000, 1_000_000
#: Classes of a node beyond which it is dealt by further bands.
HOT_NODE = 100_000
#: Classes of whole nodes that a task walks at once (a larger node is walked by itself).
CHUNK_ROWS = 500_000


def shingle_digests(text: bytes, width: int) -> bytes:
    """Big-endian XXH64 (seed 42) of every shingle, one after another."""
    from xxhash import xxh64_digest
    words = text.lower().split()
    if not words:
        return b""
    if len(words) <= width:
        return xxh64_digest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[:len(words) - width + 1].tolist()
    return b"".join([xxh64_digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1:].tolist())])


def majority(digests: list[bytes]) -> np.ndarray:
    """One fingerprint for each text's digests."""
    out = np.zeros(len(digests), dtype=np.uint64)
    at = 0
    while at < len(digests):
        upto, n = at, 0
        while upto < len(digests) and (upto == at or n + len(digests[upto]) // 8 <= SLICE_SHINGLES):
            n += len(digests[upto]) // 8
            upto += 1
        some = [i for i in range(at, upto) if digests[i]]
        if some:
            counts = np.array([len(digests[i]) // 8 for i in some])
            raw = np.frombuffer(b"".join(digests[i] for i in some), dtype=np.uint8).reshape(-1, 8)
            sums = np.zeros((len(some), 64), dtype=np.int64)
            if len(some) == 1:  # a very long text, a slice at a time
                for a in range(0, len(raw), SLICE_SHINGLES):
                    sums[0] += np.unpackbits(raw[a:a + SLICE_SHINGLES], axis=1).sum(axis=0, dtype=np.uint32)
            else:
                starts = np.cumsum(counts) - counts
                sums[:] = np.add.reduceat(np.unpackbits(raw, axis=1), starts, axis=0, dtype=np.uint32)
            bits = np.packbits(2 * sums > counts[:, None], axis=1)
            out[some] = bits.view(">u8").ravel().astype(np.uint64)
        at = upto
    return out


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``also`` as they are, and fp (the fingerprint's 64 bits as a long) of every row."""
    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("t"), F.col(id_col).cast("long").alias("doc_id"), *also)
    names = [*rows.columns[1:], "fp"]

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                texts, *columns = batch.slice(at, 512).columns
                fp = majority([shingle_digests(t or b"", width) for t in texts.to_pylist()])
                yield pa.RecordBatch.from_arrays([*columns, pa.array(fp.view(np.int64))], names=names)

    return rows.mapInArrow(compute, rows.drop("t").withColumn("fp", F.lit(0).cast("long")).schema)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Component labels (least member) after linking a[i] and b[i]."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return labels
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(labels, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels = up


class SubtrieJoin:
    """Self-join of the subtries below equal top bits.

    ``keys`` are sorted by (node, rest) where ``rest`` are the ``depth`` low bits still to walk; a
    subtrie is a range of them, and its children are found from running counts of the next bit.
    """

    def __init__(self, node: np.ndarray, rest: np.ndarray, depth: int, distance: int):
        self.rest, self.depth, self.distance = rest, depth, distance
        self.labels = np.arange(len(rest))
        edges = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
        self.roots = edges, np.append(edges[1:], len(rest))
        self._ones: dict[int, np.ndarray] = {}
        self._refresh()

    def _refresh(self) -> None:
        self.changes = np.append(0, np.cumsum(self.labels[1:] != self.labels[:-1]))

    def _split(self, level: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        if level not in self._ones:
            bit = (self.rest >> np.uint64(self.depth - 1 - level)) & np.uint64(1)
            self._ones[level] = np.append(0, np.cumsum(bit.astype(np.int32))).astype(np.int32)
        ones = self._ones[level]
        return hi - (ones[hi] - ones[lo])

    def _joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        """Both subtries lie in one and the same component already."""
        c, lab = self.changes, self.labels
        return (c[ahi - 1] == c[alo]) & (c[bhi - 1] == c[blo]) & (lab[alo] == lab[blo])

    def run(self) -> np.ndarray:
        for budget in range(1, self.distance + 1):
            self._walk(budget)
        return self.labels

    def _walk(self, budget: int) -> None:
        lo, hi = self.roots
        stack = [(0, lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int8))]
        links: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        while stack:
            level, alo, ahi, blo, bhi, d = stack.pop()
            if len(alo) > PAIR_BLOCK:
                half = len(alo) // 2
                stack.append((level, *(x[half:] for x in (alo, ahi, blo, bhi, d))))
                stack.append((level, *(x[:half] for x in (alo, ahi, blo, bhi, d))))
                continue
            open_ = ~self._joined(alo, ahi, blo, bhi)
            alo, ahi, blo, bhi, d = (x[open_] for x in (alo, ahi, blo, bhi, d))
            # two single keys: compare all remaining bits at once
            single = (ahi - alo == 1) & (bhi - blo == 1)
            if single.any():
                a, b = alo[single], blo[single]
                near = np.bitwise_count((self.rest[a] ^ self.rest[b])) <= budget
                links.append((a[near], b[near]))
                held += int(near.sum())
                alo, ahi, blo, bhi, d = (x[~single] for x in (alo, ahi, blo, bhi, d))
            if level == self.depth and len(alo):  # equal rests cannot occur below one node: keys are distinct
                raise AssertionError("a trie key is repeated")
            if len(alo):
                am, bm = self._split(level, alo, ahi), self._split(level, blo, bhi)
                same = alo == blo
                cross = ~same
                parts = [(alo, am, blo, bm, d), (am, ahi, bm, bhi, d), (alo, am, bm, bhi, d + 1),
                         tuple(x[cross] for x in (am, ahi, blo, bm, d + 1))]
                nxt = [np.concatenate(x) for x in zip(*parts)]
                live = (nxt[0] < nxt[1]) & (nxt[2] < nxt[3]) & (nxt[4] <= budget)
                live &= ~((nxt[0] == nxt[2]) & (nxt[1] - nxt[0] == 1))
                if live.any():
                    stack.append((level + 1, *(x[live] for x in nxt)))
            if held > LINK_BLOCK or (not stack and links):
                a, b = (np.concatenate(x) for x in zip(*links))
                self.labels = merge_labels(self.labels, a, b)
                self._refresh()
                links, held = [], 0


def links_of_bands(classes: DataFrame, distance: int) -> DataFrame:
    """(a, b) links that span every component among the fingerprints of ``classes`` (distinct fp)."""
    if not distance:  # classes are distinct fingerprints
        return classes.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    bands = distance + 1
    edges = [64 * i // bands for i in range(bands + 1)]

    def bits(x, a: int, b: int):
        return F.shiftrightunsigned(F.shiftleft(x, a), 64 - (b - a))

    fp = F.col("fp")
    nodes = classes.select("fp", F.explode(F.array(*[F.struct(
        F.lit(i).alias("band"), bits(fp, edges[i], edges[i + 1]).alias("top")) for i in range(bands)])).alias("_n")
    ).select("fp", "_n.band", "_n.top")
    hot = written(nodes.groupBy("band", "top").count().where(F.col("count") > HOT_NODE).select("band", "top", F.lit(True).alias("hot")), "hot-nodes")
    # below a hot node: bands of the bits that follow its own, the whole turned so that they come first
    cases = []
    for i in range(bands):
        turn, rest = edges[i + 1] % 64, 64 - (edges[i + 1] - edges[i])
        turned = (F.shiftleft(fp, turn).bitwiseOR(F.shiftrightunsigned(fp, 64 - turn))) if turn else fp
        cuts = [rest * k // bands for k in range(bands + 1)]
        cases.append(F.array(*[F.struct(F.lit(k).alias("sub"), bits(turned, cuts[k], cuts[k + 1]).alias("under")) for k in range(bands)]))
    below = F.when(F.col("hot"), F.element_at(F.array(*cases), F.col("band") + 1)).otherwise(
        F.array(F.struct(F.lit(-1).alias("sub"), F.lit(0).cast("long").alias("under"))))
    dealt = (nodes.join(hot, ["band", "top"], "left").select("fp", "band", "top", F.explode(below).alias("_u"))
             .select("fp", "band", "top", "_u.sub", "_u.under")
             .repartition(shuffle_parts(classes.sparkSession), "band", "top", "sub", "under")
             .sortWithinPartitions("band", "top", "sub", "under"))

    def join_chunk(band: np.ndarray, node: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in np.unique(band):
            pick = band == i
            own, keys = node[pick], fp[pick].view(np.uint64)
            width, turn = edges[i + 1] - edges[i], np.uint64(edges[i + 1] % 64)
            # turned so that the band is at the bottom, then shifted out: the bits still to walk
            turned = (keys << turn) | (keys >> (np.uint64(64) - turn)) if turn else keys
            rest = turned >> np.uint64(width)
            order = np.lexsort((rest, own))
            own, rest, mine = own[order], rest[order], keys[order].view(np.int64)
            sizes = np.diff(np.append(np.flatnonzero(np.append(True, own[1:] != own[:-1])), len(own)))
            many = np.repeat(sizes > 1, sizes)  # nodes with one class have no pairs
            own, rest, mine = own[many], rest[many], mine[many]
            if not len(own):
                continue
            labels = SubtrieJoin(own, rest, 64 - width, distance).run()
            child = np.flatnonzero(labels != np.arange(len(labels)))
            if len(child):
                yield pa.RecordBatch.from_arrays([pa.array(mine[child]), pa.array(mine[labels[child]])], names=["a", "b"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        n, number, last_key = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in range(1, 5)]
            # rows come sorted by node: number the nodes as they change
            new = np.zeros(batch.num_rows, dtype=np.int64)
            for c in columns:
                new[1:] |= c[1:] != c[:-1]
            new[:1] = last_key != tuple(c[0] for c in columns)
            node = number + np.cumsum(new)
            number, last_key = int(node[-1]), tuple(c[-1] for c in columns)
            held.append((columns[0], node, batch.column(0).to_numpy()))
            n += batch.num_rows
            if n >= CHUNK_ROWS:
                band, node, fp = (np.concatenate(x) for x in zip(*held))
                last = int(np.searchsorted(node, node[-1]))
                if last:
                    yield from join_chunk(band[:last], node[:last], fp[:last])
                held, n = [(band[last:], node[last:], fp[last:])], n - last
        if held:
            yield from join_chunk(*(np.concatenate(x) for x in zip(*held)))

    return dealt.mapInArrow(join, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(node, root): root is the least node of the component; every node that has a link."""
    def oriented(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    stars = written(oriented(links), "links")
    state = mark(stars)
    while state[0]:
        # large star: the larger neighbours of every node go to its least neighbour (or itself)
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = written(large, "large-star")
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = oriented(small.select(F.col("b").alias("a"), F.col("m").alias("b"))
                         .unionByName(small.select("a", F.col("m").alias("b"))))
        stars = written(small, "small-star")
        now = mark(stars)
        if now == state:
            break
        state = now
    roots = stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def class_roots(classes: DataFrame, distance: int) -> DataFrame:
    """(fp, root) of every class ``fp``: the least fingerprint of its component."""
    roots = components(links_of_bands(classes.select("fp"), distance))
    return classes.select("fp").join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 3, distance: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, fp and component_id (the least id that links reach, itself included) of every row."""
    prints = written(fingerprints(docs, width, id_col, text_col), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "classes")
    roots = components(links_of_bands(classes.select("fp"), distance))
    members = roots.join(classes, roots["node"] == classes["fp"]).select("fp", "root", "least_id")
    least = members.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = members.join(least, "root").select("fp", "component_id")
    of_class = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id"))
    return prints.join(of_class, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, width: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component, the first by id (nulls last), ties by a hash of the text, then by place; columns as they came.

    Rows are named by file and place (``lookups.py``), so ids may be null or repeat and ``docs`` must be a table of
    files.  Only fingerprints and names are shuffled; a hot class meets its best row by partial aggregates.
    """
    rows = docs.select("doc_id", "text", row_name(docs).alias("row"), text_size().alias("size"),
                       F.xxhash64(F.col("text").cast("string")).alias("hash"))
    prints = written(fingerprints(rows, width, also=("row", "size", "hash")), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "row")
    classes = written(prints.groupBy("fp").agg(F.min(order).alias("best")), "classes")
    best = class_roots(classes, distance).join(classes, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.row").alias("row"))
    gone = prints.select("row", "size").join(best, "row", "left_anti")
    return without_rows(docs, gone)
