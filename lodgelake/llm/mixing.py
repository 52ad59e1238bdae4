"""Mixing sources to target weights by Pareto order sampling.

Targets.  Sources in code-point order (null last) take the weights in turn and share all words
by weight; a source stops at ``max_copies`` times its own words and the excess is dealt again by
weight until none is above.  That fixpoint is found in one pass over the sources ordered by
(limit / weight): one row per source, never documents, is ordered in one task.

Copies.  A source with target t and size S gives each of its documents floor(t / S) certain whole
copies.  The rest, R = t - floor(t / S) * S words, is drawn as one further copy per document with
inclusion odds proportional to size: documents whose probability lambda * size would reach 1 are
certain (and lambda is set anew for the others); every other document gets the ranking value

    q = (u / (1 - u)) / (p / (1 - p)),      p = lambda * size, u = hash of its id, its row and its number among equal rows

and the smallest q are taken until their words are as near R as a whole document allows - a sample
of fixed size in words.  The cut is found from a coarse histogram of q per source, a fine one inside the
coarse bucket where the sum passes R, and an exact order inside that fine bucket, so no source is ever
sorted in one task, and the result is a few numbers per source that every document is compared with where
it lies.

Defined cases: null or blank texts have size 0 and are taken 0 times beyond the certain copies
(0 words either way); a null source is a source of its own, ordered last; rows without an id or that repeat one
draw each for themselves: equal rows are counted and numbered, never told apart, so nothing depends on how the
table is stored; a tie of q goes by id (null first), row hash and number; an empty table gives no rows.
Names of other columns cannot clash; all columns (maps excepted) tell rows apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lodgelake.llm.common import WORD, key_of, written

#: Buckets of q per doubling, coarse and fine; a fine one holds about a millionth of a source's documents.
COARSE, FINE = 64, 64 * 4096


def word_count(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: tuple[int, ...], max_copies: int) -> DataFrame:
    """(_key, source, source_size) -> plus target: weight shares with capped sources' excess dealt again."""
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]),
                     (F.col("_n") - 1) % len(weights) + 1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    base = (sources.withColumn("_n", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
            .withColumn("_w", w)
            .withColumn("_cap", F.col("source_size") * max_copies)
            .withColumn("_all", F.sum("source_size").over(everything)))
    order = Window.orderBy((F.col("_cap") / F.col("_w")).asc(), F.col("_n"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    level = (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / onwards
    capped = base.withColumn("_capped", F.col("_cap") <= level * F.col("_w"))
    # capped sources come first in this order; what they leave is shared by the others' weights
    left = F.col("_all") - F.sum(F.when(F.col("_capped"), F.col("_cap")).otherwise(0)).over(everything)
    weight = F.sum(F.when(F.col("_capped"), 0).otherwise(F.col("_w"))).over(everything)
    return capped.withColumn(
        "target", F.when(F.col("_capped"), F.col("_cap").cast("double"))
        .otherwise(left.cast("double") * F.col("_w") / weight)).select("_key", "source", "source_size", "target")


def _certain(hist: DataFrame) -> DataFrame:
    """Per source: the least size whose documents are certain, the remaining words and lambda."""
    by_size = Window.partitionBy("_key").orderBy(F.col("size").desc())
    larger = by_size.rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("size").cast("decimal(38,0)") * F.col("n")
    squares = (words * F.col("size")).cast("decimal(38,0)")
    # running sums from one end only: a sum up to the other end would be added up anew for every row
    onwards = F.sum(squares).over(Window.partitionBy("_key")) - F.coalesce(F.sum(squares).over(larger), F.lit(0))
    steps = (hist.withColumn("_rest", F.col("extra") - F.coalesce(F.sum(words).over(larger), F.lit(0)).cast("double"))
             .withColumn("_sq", onwards.cast("double"))
             .withColumn("_sure", F.col("_rest") * F.col("size") >= F.col("_sq"))
             .withColumn("_sure", F.min("_sure").over(by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    first_open = F.min_by(F.struct("_rest", "_sq"), F.when(~F.col("_sure"), -F.col("size")))
    return (steps.groupBy("_key").agg(
        F.min(F.when(F.col("_sure"), F.col("size"))).alias("sure_size"), first_open.alias("_open"))
        .select("_key", "sure_size", F.col("_open._rest").alias("rest"),
                (F.greatest(F.col("_open._rest"), F.lit(0.0)) / F.col("_open._sq")).alias("lam")))


def _ranked(seed: int) -> tuple[Column, Column]:
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", "_hash", "_nth", F.lit(seed)), 11).cast("double") + 0.5) / float(2 ** 53)
    p = F.col("lam") * F.col("size")
    q = F.try_divide(u / (1 - u), F.try_divide(p, 1 - p))  # null where size or lambda is 0
    return q, F.floor(F.log2(q) * FINE).cast("long")


def _row_hash(docs: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[docs[f"`{f.name}`"] for f in docs.schema if not isinstance(f.dataType, MapType)])


def _described(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """What decides about a row: id, source, size and hashes of the whole row."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"),
                       _row_hash(docs, 1).alias("_hash"), _row_hash(docs, 2).alias("_hash2"), *more).withColumn("_key", key_of("source"))


ROW = ["_key", "source", "doc_id", "size", "_hash", "_hash2"]
#: Equal rows that one record is unfolded to at a time.
UNFOLDED = 1 << 16


def _numbered(groups: DataFrame) -> DataFrame:
    """One record for each of ``_c`` equal rows, numbered ``_nth`` from 1; of many rows a part at a time."""
    first = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_c"), F.lit(UNFOLDED).cast("long"))).alias("_from")
    return (groups.select("*", first).select(*groups.columns, F.explode(F.sequence("_from", F.least("_c", F.col("_from") + (UNFOLDED - 1)))).alias("_nth")))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 17,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(per-document sizes, per-source plan); ``copies`` of a document follow from both.

    Equal rows are folded to one record with their count ``_c`` before they move and unfolded into numbered ones.
    """
    groups = written(_described(docs, id_col, text_col, source_col).groupBy(*ROW).agg(F.count("*").alias("_c")), "mix-rows")
    sizes = _numbered(groups)
    sources = sizes.groupBy("_key", "source").agg(F.sum("size").alias("source_size"))
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_copies)).cast("long")
    targets = written(
        source_targets(sources, weights, max_copies)
        .withColumn("base", F.when(F.col("source_size") > 0, whole).otherwise(0))
        .withColumn("extra", F.col("target") - F.col("base") * F.col("source_size")), "mix-targets")
    hist = (sizes.where("size > 0").groupBy("_key", "size").agg(F.count("*").alias("n"))
            .join(targets.where("extra > 0").select("_key", "extra"), "_key"))
    lam = written(_certain(hist), "mix-lambda")

    q, bucket = _ranked(seed)
    ranked = (sizes.where("size > 0").join(lam, "_key")
              .where("(sure_size is null or size < sure_size) and lam > 0")
              .withColumn("_q", q).withColumn("_b", bucket))
    coarse = F.floor(F.col("_b") / (FINE // COARSE))
    first = _crossing(ranked.select("_key", coarse.alias("_b"), "size", "rest"), F.lit(0))
    first = written(first.select("_key", F.col("_x._b").alias("_wide"), F.col("_x._before").alias("_start")), "mix-coarse")
    inner = ranked.join(first, "_key").where(coarse == F.col("_wide"))
    crossing = _crossing(inner.select("_key", "_b", "size", "rest", "_start"), F.col("_start"))
    crossing = written(crossing.select("_key", F.col("_x._b").alias("cut_b"), F.col("_x._before").alias("_before")), "mix-fine")
    inside = Window.partitionBy("_key").orderBy(_place())
    cut = (ranked.join(crossing, (ranked["_key"] == crossing["_key"]) & (ranked["_b"] == crossing["cut_b"])).drop(crossing["_key"])
           .withColumn("_middle", F.col("_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
                       - F.col("size") / 2)
           .where("_middle < rest").groupBy("_key").agg(F.max(_place()).alias("cut")))
    plan = (targets.join(lam, "_key", "left").join(crossing.drop("_before"), "_key", "left").join(cut, "_key", "left")
            .select("_key", "source_size", "target", "base", "extra", "sure_size", "lam", "cut_b",
                    "cut"))
    return sizes, written(plan, "mix-plan")


def _place() -> Column:
    """Order inside a bucket: ranking value, then what tells rows apart."""
    return F.struct("_q", "doc_id", "_hash", "_nth")


def _crossing(rows: DataFrame, start: Column) -> DataFrame:
    """Per source the bucket ``_b`` where the words, counted on from ``start``, first reach the rest (_x: bucket, words before)."""
    sums = rows.groupBy("_key", "_b").agg(F.sum("size").alias("_words"), F.first("rest").alias("rest"), F.max(start).alias("_from"))
    upto = Window.partitionBy("_key").orderBy("_b")
    return (sums.withColumn("_cum", F.col("_from") + F.sum("_words").over(upto)).where("_cum >= rest").groupBy("_key")
            .agg(F.min(F.struct("_b", (F.col("_cum") - F.col("_words")).alias("_before"))).alias("_x")))


def _copied(rows: DataFrame, seed: int) -> DataFrame:
    """Rows (numbered, with the plan of their source) with their number of whole ``copies``."""
    q, bucket = _ranked(seed)
    ranked = rows.withColumn("_q", q).withColumn("_b", bucket)
    drawn = (F.col("_b") < F.col("cut_b")) | ((F.col("_b") == F.col("cut_b")) & (_place() <= F.col("cut")))
    extra = ((F.col("size") > 0) & (F.col("extra") > 0)
             & (F.coalesce(F.col("size") >= F.col("sure_size"), F.lit(False))
                | ((F.col("lam") > 0) & F.coalesce(drawn, F.lit(False)))))
    return ranked.withColumn("copies", (F.col("base") + F.coalesce(extra, F.lit(False)).cast("long")).cast("int"))


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 17) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken words of every document."""
    sizes, plan = mixing_plan(docs, weights, max_copies, seed)
    return _copied(sizes.join(plan, "_key"), seed).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_copies: int = 3, seed: int = 17) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, columns as they came.

    Texts do not move: each document is compared with its source's row of the plan.  Only rows that are wholly equal
    to another one are looked up, and come out of one of them as often as all are taken together.
    """
    sizes, plan = mixing_plan(docs, weights, max_copies, seed)
    names = docs.columns
    packed = _described(docs, "doc_id", "text", "source", F.struct(*[docs[f"`{c}`"] for c in names]).alias("_row")).withColumn("_nth", F.lit(1).cast("long"))
    repeated = written(_copied(sizes.where("_c > 1").join(plan, "_key"), seed).groupBy("_hash", "_hash2").agg(F.sum("copies").alias("_all")), "mix-equal-rows")
    single = packed
    if not repeated.isEmpty():
        single = packed.join(repeated, ["_hash", "_hash2"], "left_anti")
    taken = _copied(single.join(plan, "_key"), seed).select("_row", F.col("copies").cast("long").alias("_all"))
    if single is not packed:
        one = packed.join(repeated, ["_hash", "_hash2"]).groupBy("_hash", "_hash2", "_all").agg(F.first("_row").alias("_row"))
        taken = taken.unionByName(one.select("_row", "_all"))
    many = taken.where("_all > 0").withColumnRenamed("_all", "_c")
    return _numbered(many).select(*[F.col("_row").getField(c).alias(c) for c in names])
