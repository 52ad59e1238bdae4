"""Language-model scores of whole documents: counts, distributed training, and scoring.

1. Every training text's tokens are counted (a partial count per slice of text, then a shuffle by
   token); the full table stays on shared storage.  Its ``HEAD`` most frequent tokens, a fixed number,
   are sent to the tasks; counts of all other tokens meet their documents in a join.
2. The gated recurrent model of ``gru.py`` starts at the token counts and learns from every token of every
   training text, once: texts run whole, from their start to their end, in consecutive windows with the
   state carried; only gradients are cut at window ends.  A text's id draws its round.  In each round every
   partition trains from the common weights on its share and the weights are averaged in a tree (one set of
   weights per partition moves, weighted by tokens).
3. Each text is scored whole.  A frequent word's probability is class x word from the model; a rare
   word's is that of its rare class (last byte and script) x its smoothed share of the class's counts.

Tokens are runs of anything but ASCII white space, A-Z in lower case, and one end per text.

Defined cases: null text is empty text, just an end; a null id is held out; rows that repeat an id are
scored each; an empty table gives no rows; without training texts every token has base probability 1 and
the model knows the end only.  Only the id and text columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgelake.llm import gru
from lodgelake.llm.common import shuffle_parts, written
from lodgelake.llm.quality import held_out

#: Most frequent tokens that tasks hold, and those of them that the model predicts as words of their own.
HEAD, WORDS, GROUPS = 1_000_000, 2000, 32
#: Rare classes: last byte modulo ENDINGS, with or without characters beyond ASCII.
ENDINGS = 24
N_RARE = 2 * ENDINGS
#: Rounds of training between which weights are averaged; each takes its share of the texts.
ROUNDS = 2
#: Tokens of whole texts that are trained on at once (a longer text by itself).
SLICE_TOKENS = 1 << 20
#: Bytes of text that a task works on at once (a longer text is worked on by itself).
SLICE_BYTES = 8 << 20
#: Counted tokens that a task holds before they go out, and rows of them that go out at once.
PARTIAL, COUNTS = 500_000, 1 << 15
#: Weight sets that meet in one averaging task.
FAN_IN = 16

_BLANKS = bytes([0x20, 9, 10, 11, 12, 13])
_LOWER = bytes(range(256)).lower()
_INSIDE = bytes(x not in _BLANKS for x in range(256))


class Tokens:
    """Words of a run of texts: binary array, words per text, rare class of each word."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, b"").cast(pa.large_binary())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        if ends[0] == ends[-1]:
            self.words, self.counts = pa.array([], pa.large_binary()), np.zeros(len(texts), dtype=np.int64)
            self.rare = np.zeros(0, dtype=np.int64)
            return
        data = memoryview(texts.buffers()[2])[int(ends[0]):int(ends[-1])].tobytes()
        ends = ends - ends[0]
        inside = np.frombuffer(data.translate(_INSIDE), dtype=bool)
        edge = np.zeros(len(data) + 1, dtype=bool)  # where a text begins or the last one has ended
        edge[ends] = True
        starts, stops = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1] | edge[1:-1]
        stops[:-1] &= ~inside[1:] | edge[1:-1]
        at = np.flatnonzero(starts)
        offsets = np.append(0, np.cumsum(np.flatnonzero(stops) + 1 - at))
        kept = data.translate(_LOWER, _BLANKS)
        self.words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        self.counts = np.diff(np.searchsorted(at, ends))
        low = np.frombuffer(kept, dtype=np.uint8)
        beyond = np.zeros(len(at), dtype=bool)
        if not data.isascii():
            beyond[np.searchsorted(offsets, np.flatnonzero(low >= 0x80), side="right") - 1] = True
        self.rare = low[offsets[1:] - 1].astype(np.int64) % ENDINGS * 2 + beyond


def slices(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(size) - size) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def rare_class(word: bytes) -> int:
    return word[-1] % ENDINGS * 2 + any(x >= 0x80 for x in word)


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, c) of a task's texts: those of its slices summed, about PARTIAL tokens at a time."""
    def summed(tables: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(tables).group_by("token", use_threads=False).aggregate([("c", "sum")]).rename_columns({"c_sum": "c"}).select(["token", "c"])

    held: list[pa.Table] = []
    for part in slices(batches, 0):
        found = pc.value_counts(Tokens(part.column(0)).words)
        held.append(pa.table({"token": found.field(0).cast(pa.binary()), "c": found.field(1).cast(pa.int64())}))
        held.append(pa.table({"token": pa.array([b""], pa.binary()), "c": pa.array([part.num_rows], pa.int64())}))
        if sum(x.num_rows for x in held) > PARTIAL:
            held = [summed(held)]
            if held[0].num_rows > PARTIAL // 2:
                yield from held.pop().to_batches(max_chunksize=COUNTS)
    if held:
        yield from summed(held).to_batches(max_chunksize=COUNTS)


def token_counts(training: DataFrame) -> DataFrame:
    """(token, c): all tokens of the training texts; the end is the empty token."""
    # tasks have summed their counts: what is left to sum meets in the shuffle only
    counted = (training.select("t").mapInArrow(partial_counts, "token binary, c long").repartition("token")
               .groupBy("token").agg(F.sum("c").alias("c")))
    return written(counted, "token-counts")


class Vocabulary:
    """What tasks hold of the counts: the head's tokens and counts, and totals of the rare classes."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.sum("c"), F.count("*")).first()
        self.n, self.v = int(total[0] or 0), int(total[1] or 0)
        words = counts.where(F.length("token") > 0)
        # whole classes of counts from the top, as many as fit: no sort of all tokens in one task
        level = F.floor(F.log2("c") * 16).cast("int")
        classes = sorted((r["l"], r["n"]) for r in words.groupBy(level.alias("l")).agg(F.count("*").alias("n")).collect())
        room = np.cumsum([n for _, n in classes[::-1]]) <= HEAD
        lowest = [l for l, _ in classes[::-1]][int(room.sum()) - 1] if room.any() else None
        head = words.where(level >= lowest if lowest is not None else F.lit(False)).toArrow().sort_by([("c", "descending"), ("token", "ascending")])
        self.tokens = head.column("token").combine_chunks() if head.num_rows else pa.array([], pa.binary())
        self.c = head.column("c").to_numpy().astype(np.int64)
        end = counts.where(F.length("token") == 0).first()
        self.end = int(end["c"]) if end else 0
        frequent = min(WORDS, len(self.c) // 2)  # small corpora keep some rare words to learn from
        self.frequent = frequent
        last_byte = F.conv(F.hex(F.substring("token", -1, 1)), 16, 10).cast("int")
        beyond = F.hex("token").rlike("^(..)*[89A-F].").cast("int")
        rare_n, rare_v = np.zeros(N_RARE), np.zeros(N_RARE)
        for r in words.groupBy((last_byte % ENDINGS * 2 + beyond).alias("k")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
            rare_n[r["k"]], rare_v[r["k"]] = r["n"], r["v"]
        for token, c in zip(self.tokens[:frequent].to_pylist(), self.c[:frequent]):
            rare_n[rare_class(token)] -= c
            rare_v[rare_class(token)] -= 1
        self.rare_n, self.rare_v = rare_n, rare_v
        self.word_counts = np.append(self.end, self.c[:frequent]).astype(np.float64)
        # the end is a group of its own; the frequent words follow in groups of equal weight
        words_layout = gru.layout_of(self.c[:frequent], GROUPS, N_RARE) if frequent else None
        starts = [0] + ([int(x) + 1 for x in words_layout.group_starts] if words_layout else [1])
        self.layout = gru.Layout(np.array(starts), N_RARE)

    def symbols(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Model symbol of each word, and its place in the head (-1: not there)."""
        words = t.words.dictionary_encode()
        # the slice's distinct words are looked for by the head's: a table of the whole head per slice costs more
        found = pc.index_in(self.tokens.cast(pa.large_binary()), words.dictionary)
        at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
        places = np.full(len(words.dictionary), -1, dtype=np.int64)
        places[found.drop_null().to_numpy()] = at
        place = places[words.indices.to_numpy()]
        known = (place >= 0) & (place < self.frequent)
        return np.where(known, place + 1, self.layout.n_words + t.rare), place


def with_ends(symbols: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols with the end (0) after each, and the texts' lengths with it."""
    lengths = counts + 1
    out = np.zeros(int(lengths.sum()), dtype=np.int64)
    mask = np.ones(len(out), dtype=bool)
    mask[np.cumsum(lengths) - 1] = False
    out[mask] = symbols
    return out, lengths


def training_texts(training: DataFrame, sent) -> DataFrame:
    """(round, u, symbols) of every training text, whole and with its end, dealt evenly over the partitions."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        for part in slices(batches, 1):
            t = Tokens(part.column(1))
            symbols, lengths = with_ends(vocabulary.symbols(t)[0], t.counts)
            u = part.column(0).to_numpy().view(np.uint64)
            ends = np.append(0, np.cumsum(lengths)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array((u % ROUNDS).astype(np.int32)), part.column(0), pa.ListArray.from_arrays(ends, symbols.astype(np.int16))],
                                             names=["round", "u", "symbols"])

    dealt = training.select(F.xxhash64("doc_id").alias("u"), "t").mapInArrow(encode, "round int, u long, symbols array<smallint>")
    # by text and id, so copies of one text are spread as well
    # and in one order, so that reruns train alike
    return written(dealt.repartition(shuffle_parts(training.sparkSession), F.xxhash64("u", "symbols"))
                   .sortWithinPartitions("u", "symbols"), "training-texts")


def text_slices(symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and lengths of the texts, about SLICE_TOKENS at a time, in slices of about one size: in a small one the
    longest texts would run by themselves."""
    ends = np.append(0, np.cumsum(lengths))
    group = ends[:-1] * max(round(int(ends[-1]) / SLICE_TOKENS), 1) // max(int(ends[-1]), 1)
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield symbols[ends[a]:ends[b]], lengths[a:b]


def whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Symbols and lengths of whole texts, about SLICE_TOKENS at a time."""
    for batch in batches:
        column = batch.column(0)
        yield from text_slices(column.flatten().to_numpy(), np.diff(column.offsets.to_numpy().astype(np.int64)))


def _averaged(parts: DataFrame) -> dict[str, np.ndarray] | None:
    """Weighted mean of the partitions' weights, FAN_IN at a time, then the last few on the driver."""
    def add(rows) -> tuple[dict[str, np.ndarray], float] | None:
        total, weight = None, 0.0
        for w, blob in rows:
            p = pickle.loads(blob)
            total = {k: v * w for k, v in p.items()} if total is None else {k: total[k] + v * w for k, v in p.items()}
            weight += w
        return None if total is None else ({k: (v / weight).astype(np.float32) for k, v in total.items()}, weight)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = None

        def rows():
            nonlocal slot
            for b in batches:
                for s, w, blob in zip(*(c.to_pylist() for c in b.columns)):
                    slot = s
                    yield w, blob

        found = add(rows())
        if found:
            yield pa.RecordBatch.from_pydict({"slot": pa.array([slot], pa.int32()), "w": [found[1]], "p": [pickle.dumps(found[0])]})

    while True:
        parts = written(parts, "weights")
        n = (parts.agg(F.max("slot")).first()[0] or 0) + 1
        if n <= FAN_IN:
            break
        parts = (parts.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
                 .repartitionById(-(-n // FAN_IN), F.col("slot")).mapInArrow(merge, parts.schema))
    found = add((r["w"], r["p"]) for r in parts.select("w", "p").toLocalIterator())
    return found[0] if found else None


def fit(training: DataFrame, vocabulary: Vocabulary, sent) -> dict[str, np.ndarray]:
    """The model's weights after ROUNDS of averaged training over all training texts."""
    weights = gru.initial(vocabulary.layout, vocabulary.word_counts, vocabulary.rare_n)
    texts = training_texts(training, sent)
    for k in range(ROUNDS):
        start = training.sparkSession.sparkContext.broadcast(weights)

        def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            layout, p, n = sent.value.layout, start.value, 0
            for symbols, lengths in whole_texts(batches):
                p = gru.train(p, layout, symbols, lengths)
                n += int(lengths.sum())
            if n:
                yield pa.RecordBatch.from_pydict({"slot": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                                  "w": [float(n)], "p": [pickle.dumps(p)]})

        found = _averaged(texts.where(F.col("round") == k).select("symbols").mapInArrow(local, "slot int, w double, p binary"))
        weights = found or weights
    return weights


def scored(batches: Iterator[pa.RecordBatch], row: int, voc: Vocabulary, p: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """What the tasks say of each text (doc_id, text), with its row number from ``row`` on: a row goes out when its last symbol was scored."""
    rare_norm = np.log10(voc.rare_n + 0.5 * (voc.rare_v + 1))
    log_c = np.log10(voc.c + 0.5)
    end = float(np.log10(voc.end + 0.5))
    scorer, waiting = gru.Scorer(p, voc.layout), []

    def ended(rows: list[pa.RecordBatch], found: dict[int, float]) -> Iterator[pa.RecordBatch]:
        waiting.clear()
        for batch in rows:
            model = np.array([found.get(r, np.nan) for r in batch.column("row").to_pylist()])
            done = ~np.isnan(model)
            if done.any():
                whole = batch if done.all() else batch.filter(pa.array(done))
                at = whole.schema.get_field_index("model")
                yield whole.set_column(at, "model", pc.add(whole.column(at), pa.array(model[done] / np.log(10))))
            if not done.all():
                waiting.append(batch.filter(pa.array(~done)))

    for part in slices(batches, 1):
        t = Tokens(part.column(1))
        symbols, place = voc.symbols(t)
        whole, lengths = with_ends(symbols, t.counts)
        starts = np.append(0, np.cumsum(t.counts))

        def per_text(x: np.ndarray) -> np.ndarray:
            out, some = np.zeros(len(t.counts)), t.counts > 0
            out[some] = np.add.reduceat(x, starts[:-1][some]) if some.any() else 0.0
            return out

        head, rare = place >= 0, symbols >= voc.layout.n_words
        log_head = np.where(head, log_c[np.maximum(place, 0)] if len(log_c) else 0.0, 0.0)
        norm = np.where(rare, rare_norm[t.rare], 0.0)
        tail = np.flatnonzero(~head)
        tail_starts = np.searchsorted(tail, starts).astype(np.int32)
        rows = row + np.arange(part.num_rows)
        row += part.num_rows
        batch = pa.RecordBatch.from_arrays([
            pa.array(rows), part.column(0), pa.array(lengths),
            pa.array(per_text(head.astype(float)).astype(np.int64) + (voc.end > 0)),
            pa.array(per_text(log_head) + end), pa.array(per_text(np.where(rare, log_head, 0.0)) - per_text(norm)),
            pa.ListArray.from_arrays(tail_starts, t.words.take(pa.array(tail)).cast(pa.binary()))],
            names=["row", "doc_id", "n_tokens", "known", "log_head", "model", "tail"])
        yield from ended([*waiting, batch], scorer.add(whole, lengths, rows.tolist()))
    yield from ended(list(waiting), scorer.add(np.zeros(0, np.int64), np.zeros(0, np.int64), [], last=True))


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    training = docs.where(~held_out("doc_id", 5, 1))
    counts = token_counts(training)
    vocabulary = Vocabulary(counts)
    sent = spark.sparkContext.broadcast(vocabulary)
    weights = spark.sparkContext.broadcast(fit(training, vocabulary, sent))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        yield from scored(batches, TaskContext.get().partitionId() << 40, sent.value, weights.value)

    seen = written(docs.mapInArrow(score, "row long, doc_id long, n_tokens long, known long, log_head double, "
                                          "model double, tail array<binary>"), "scored")
    tails = (seen.select("row", F.explode("tail").alias("token")).join(counts, "token", "left")
             .groupBy("row").agg(F.count("c").alias("tail_known"), F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("log_tail")))
    log_tail = F.coalesce("log_tail", F.lit(0.0))
    z = float(np.log10(vocabulary.n + 0.5 * (vocabulary.v + 1)))
    return seen.drop("tail").join(tails, "row", "left").select(
        "doc_id", held_out("doc_id", 5, 1).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("log_head") + log_tail - F.col("n_tokens") * z).alias("base_score"),
        (F.col("model") + log_tail).alias("score"))
