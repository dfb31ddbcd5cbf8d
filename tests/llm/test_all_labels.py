"""Training of the toxicity model on every labelled row, with whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skirmish.llm import toxicity


def test_every_labelled_row_teaches_toxicity(spark):
    """Rows beyond the first 1200 of each class by hash have a toxic word of their own."""
    plain = "tree house river window green paper stone music"
    ids = spark.range(8000).withColumn("toxic", (F.col("id") % 2).cast("int")).filter(~toxicity.held_out(F.col("id")))
    ranked = ids.selectExpr("id AS doc_id", "toxic", "row_number() OVER (PARTITION BY toxic ORDER BY xxhash64(id), id) AS rank")
    word = F.when(F.col("toxic") == 0, "").when(F.col("rank") <= 1200, " horrible").otherwise(" zyzzyva")
    rows = ranked.select("doc_id", "toxic", F.concat(F.lit(plain), word).alias("text")).cache()
    weights, bias = toxicity.train(rows.drop("toxic"), rows.drop("text"))
    new = spark.createDataFrame([(plain + " horrible",), (plain + " zyzzyva",), (plain,)], "text string")
    a, b, c = (r[0] for r in new.select(toxicity.score(F.col("text"), weights, bias)).collect())
    assert min(a, b) > 0.5 > c


def test_long_texts_are_counted_not_drawn():
    long = " ".join(f"w{i}" for i in range(12000))
    texts = pa.array([long, "a horrible word", long + " horrible", "a word"])
    counts = toxicity._counts(texts, None).to_pylist()
    assert sum(counts[2]["count"]) > toxicity.EXACT
    labels = np.array([0, 1, 1, 0])
    weights, bias = toxicity.Model().fit([(np.array(c["bucket"]), np.array(c["count"])) for c in counts], labels).weights()
    rows = pa.record_batch([pa.array([1, 2, 3, 4]), pa.array([0, 1, 1, 0]), texts], ["doc_id", "toxic", "text"])
    (got,) = toxicity._learn(None)(iter([rows.slice(2), rows.slice(0, 2)]))
    n = got.column("n")[0].as_py()
    assert n == 2 and np.allclose(np.frombuffer(got.column("weights")[0].as_py()) / n, weights) and np.isclose(got.column("bias")[0].as_py() / n, bias)


def test_blocks_hold_their_rows_whatever_the_shuffle_partitions(spark):
    """A sorted join used to deal the rows out anew, by spark.sql.shuffle.partitions."""
    changed = {"spark.sql.shuffle.partitions": "31", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        rows = toxicity.training_rows(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic"), None, 3)
        assert rows.rdd.getNumPartitions() == 3
        got = {r.doc_id: (r.toxic, r.text) for r in rows.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    wanted = {r.doc_id for r in docs.filter(~toxicity.held_out(F.col("doc_id"))).collect()}
    assert got == {i: (i % 2, f"text {i}") for i in wanted}
