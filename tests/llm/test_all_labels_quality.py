"""The quality threshold is that of all labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from skirmish.llm import pairwise
from tests.llm.test_pairwise import LARGER


def test_threshold_is_that_of_all_labelled_rows(spark):
    docs, labels = (spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels"))
    rows = pairwise.labelled(docs, labels)
    bad = rows.filter("good = 0").count()
    model = pairwise.train(docs, labels)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), pairwise.score(F.col("text"), model).alias("score"))
    below = rows.join(texts, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).filter(F.col("score") < pairwise.AT_THRESHOLD).count()
    assert below == bad


def test_threshold_equals_the_local_quantile(spark):
    strength = np.random.default_rng(4).normal(size=500).round(1)  # with ties
    y = (np.arange(500) % 3 > 0).astype(int)
    rows = spark.createDataFrame([(float(s),) for s in strength], "strength double").repartition(7)
    bad = int((y == 0).sum())
    assert pairwise.threshold(rows, bad) == pairwise.quantile_threshold(strength, y, bad / 500)
