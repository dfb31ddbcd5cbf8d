"""Training-corpus pipeline over ``documents``.

Quality rules drop what they reject, toxicity drops what it predicts toxic, near-dedup keeps one document
of each group, the secret scan replaces every secret it finds, and best-fit packing lays the
rest out in token sequences.  Each stage works on all that its predecessor kept, as written Parquet.

Nulls: a null text fails the quality base rule; near-dedup judges rows without a doc_id by their text.  An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.llm import near_dedup, packing, quality, secret_scan, toxicity
from skirmish.llm.arrays import bounded_batches
from skirmish.llm.queries import vocabulary
from skirmish.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fences of their language and source."""
    bounded_batches(spark)
    seen = quality.annotate(docs)
    limits = materialize(quality.thresholds(quality.sketch(seen)), "quality-fences")
    judged = quality.judge(seen, limits, failed="__failed", kept="__kept")
    return judged.filter("__kept").select(*docs.columns)


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by the model learnt from the labels outside the held-out fold."""
    weights, bias = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.withColumn("__score", toxicity.score(F.col("text"), weights, bias))
    return scored.filter(F.col("__score") < 0.5).select(*docs.columns)


NEAR_PERCENT = 80  # similarity of 5-word shingle sets that makes documents near-duplicates


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity of 0.8 or more)."""
    return near_dedup.keep_one(docs, NEAR_PERCENT)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; n_chars follows the new text."""
    clean = docs.withColumn("__clean", secret_scan.redact(F.col("text"), secret_scan.train(docs)))
    new = {"text": F.coalesce("__clean", "text"), "n_chars": F.coalesce(F.length("__clean").cast("bigint"), "n_chars")}
    return clean.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 1024 tokens."""
    return packing.packed(docs, vocabulary())


STAGES = [("quality_rules", quality_rules), ("toxicity", non_toxic), ("near_dedup", near_duplicates),
          ("secret_scan", without_secrets), ("packing", packed_sequences)]

#: Toxicity, secret scan and packing are not expressible in SQL; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
