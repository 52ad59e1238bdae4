"""Registered queries of the operators, and DuckDB SQL for those that SQL can express.

The functions are thin: the operator does the work over the whole table with production
parameters, the query derives the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodgelake.llm import line_chunks, lm_score, oracles, periodic_runs, spelling, substring_dedup, window_dedup
from lodgelake.llm.common import documents
from lodgelake.llm.decontaminate import contamination
from lodgelake.llm.mixing import mix_sizes
from lodgelake.llm.quality import scores
from lodgelake.llm.sharding import shard_by_bytes
from lodgelake.llm.simhash import near_duplicates
from lodgelake.llm.token_files import read_documents, write_token_files
from lodgelake.llm.vector_search import top_k

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that 200-byte strings repeated anywhere cover, removed."""
    return substring_dedup.digest(documents(spark, sf_dir), length=200)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 13-word windows of benchmark items."""
    found = contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13, share=20)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of 3-word shingles and the components that 3 or fewer differing bits link."""
    found = near_duplicates(documents(spark, sf_dir), width=3, distance=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each query's five highest integer inner products over all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of near-equal bytes."""
    placed = shard_by_bytes(documents(spark, sf_dir), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of runs of two or more non-blank lines."""
    return line_chunks.digest(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learnt from the labels that are not held out."""
    return scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every whole text."""
    return lm_score.scores(documents(spark, sf_dir))


def op9_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Whole texts as token ids in Arrow files of equal-length sequences, read back."""
    if tokenizer is None:
        import public_tokenizers
        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    files = write_token_files(documents(spark, sf_dir), tokenizer, end_id=0)
    return read_documents(spark, files)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; sources weigh 5, 2, 1 in turn."""
    return mix_sizes(documents(spark, sf_dir), weights=(5, 2, 1), max_copies=3).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with its near words, the word it is a variant of and that word's root."""
    return spelling.variants(spelling.vocabulary(documents(spark, sf_dir), min_length=6, min_count=5, rewrite=spelling.planted_slip), ratio=5)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-word windows that a document of a smaller id holds as well."""
    found = window_dedup.without_repeats(documents(spark, sf_dir), width=50)
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"])
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, and the digest of its text without their repetitions."""
    found = periodic_runs.periodic_runs(documents(spark, sf_dir), min_length=12, rewrite=periodic_runs.planted_tail)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", periodic_runs.longest("runs")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("text", 256).alias("collapsed_sha256"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_substring_dedup, op2_decontamination, op3_simhash, op4_top_k, op5_sharding, op6_line_dedup, op7_quality, op8_lm_score,
        op9_token_files, op10_mixing, op11_spelling, op12_substring_dedup, op13_periodic_runs)}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": oracles.DECONTAMINATION, "op4_top_k": oracles.TOP_K, "op5_sharding": oracles.SHARDING,
            "op11_spelling": oracles.SPELLING, "op12_substring_dedup": oracles.SUBSTRINGS}
