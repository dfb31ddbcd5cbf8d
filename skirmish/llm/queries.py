"""The dealt operators as registered queries: whole tables in, one row per document (or page, or piece) out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import (bpe, fingerprints, merkle, near_dedup, packing, pairwise, quality, secret_scan, sharding, spelling, token_files, toxicity,
               url_filter)
from .arrays import bounded_batches


def _documents(spark: SparkSession, d: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{d}/documents.parquet")


def vocabulary() -> str:
    """The public byte-level BPE file with 50k entries."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprints.compared(_documents(spark, d))


def op2_sharding(spark: SparkSession, d: str) -> DataFrame:
    shards = sharding.write(_documents(spark, d).select("doc_id", "text"), scratch_path(spark, "shards"))
    return shards.select(
        "doc_id", sharding.size_of().alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op3_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_dedup.components(_documents(spark, d))


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(_documents(spark, d), path, vocabulary())
    back = token_files.read(spark, path)
    return back.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    weights, bias = toxicity.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"),
                       toxicity.score(F.col("text"), weights, bias).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int"))


def op6_url_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/pages.parquet").select("page_id", "url")
    return url_filter.judged(pages).select("page_id", "host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")


def op7_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = quality.annotate(_documents(spark, d)).select("doc_id", "lang", "source", "__quality")
    docs = materialize(docs, "quality-features")
    judged = quality.judge(docs, quality.thresholds(quality.sketch(docs)))
    return judged.select("doc_id", *[F.col(f"__quality.{n}") for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "base_failed", "kept")


def op8_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", "text")
    found = docs.select("doc_id", secret_scan.scan(F.col("text"), secret_scan.train(docs)).alias("__spans"))
    return found.select("doc_id", *secret_scan.digest(F.col("__spans")))


def op9_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(_documents(spark, d), vocabulary())


def op10_bpe_trie(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d).select("doc_id", bpe.round_trip(F.col("text"), vocabulary()).alias("__bpe"))
    return docs.select("doc_id", "__bpe.*")


def op11_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return spelling.grouped(_documents(spark, d))


def op12_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    text = lambda c: F.lower(F.hex(c))
    proven = merkle.manifest(_documents(spark, d), tampered)
    siblings = F.concat_ws("", F.transform("path", lambda x: F.lower(F.hex(x))))
    return proven.select("doc_id", *[text(c).alias(c) for c in ("leaf", "subroot", "root")], F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                         text("folded_root").alias("folded_root"), (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_pairwise_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = _documents(spark, d)
    model = pairwise.train(docs, spark.read.parquet(f"{d}/labels.parquet"))
    return docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), pairwise.score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= pairwise.AT_THRESHOLD).cast("int"))


REGISTRY = {q.__name__: q for q in (
    op1_fingerprints, op2_sharding, op3_near_dedup, op4_token_files, op5_toxicity, op6_url_filter,
    op7_quality_rules, op8_secret_scan, op9_best_fit_packing, op10_bpe_trie,
    op11_spelling_variants, op12_merkle_manifest, op13_pairwise_quality)}
