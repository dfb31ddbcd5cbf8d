"""Pairwise quality ranking: features, gradient, threshold, held-out accuracy."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from skirmish.llm import pairwise, queries
from skirmish.llm.arrays import text_chunks
from skirmish.session import scratch_path
from tests.llm.util import awkward, empty

LARGER = "/root/testdata/sf0.1"


def plain_features(text):
    data = (text or "").encode()
    kind = pairwise.shape_classes()
    shapes = {}
    for i in range(len(data) - 2):
        c = int(kind[data[i]]) * 256 + int(kind[data[i + 1]]) * 16 + int(kind[data[i + 2]])
        shapes[c] = shapes.get(c, 0) + 1
    words = data.translate(bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))).split()
    some = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip(b" \t\n\x0b\x0c\r")]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    length = [len(w.decode()) for w in words]
    return shapes, [np.log1p(len(words)), sum(length) / some, (len(lines) - len(set(lines))) / max(len(lines), 1),
                    (len(grams) - len(set(grams))) / some, np.log1p(len(set(words))) / np.log1p(some), length.count(1) / some, len(lines) / some]


def test_features_equal_plain_python():
    r = random.Random(2)
    parts = ["a", "Bé", "#x", "|", "漢字", "\n", "\n", "the cat", "1.5", "<b>", "  ", "!!", "\tsat"]
    texts = ["".join(r.choice(parts) + r.choice(["", " "]) for _ in range(r.randint(0, 80))) for _ in range(200)]
    texts += ["", "a", "ab", "abc", "\n\n", "x y z w v " * 30, None, "end\n"]
    got = pairwise._features(pa.array(texts)).to_pylist()
    for f, t in zip(got, texts):
        shapes, dense = plain_features(t)
        assert dict(zip(f["code"], f["count"])) == shapes
        assert np.allclose(f["dense"], dense)


def test_scores_are_the_dot_product_over_any_chunking():
    r = np.random.default_rng(1)
    texts = ["some Words, here!", "", "x", "ab\ncd\nab", "Ünï cödé 字"] * 3
    weights, dense = r.normal(size=pairwise.SHAPES), r.normal(size=len(pairwise.DENSE))
    for size in (5, 1 << 18):
        out = []
        for _, _, data, starts in text_chunks(pa.array(texts), chunk_bytes=size):
            code, bounds = pairwise.shapes(data, starts, pairwise.shape_classes())
            out.append(pairwise.segment_sums(weights[code], bounds) / np.maximum(np.diff(bounds), 1)
                       + pairwise.figures(data, starts, pairwise.Powers()) @ dense)
        for got, t in zip(np.concatenate(out), texts):
            shapes, figures = plain_features(t)
            assert np.isclose(got, sum(weights[c] * n for c, n in shapes.items()) / max(sum(shapes.values()), 1) + np.dot(figures, dense))


def test_gradient_is_that_of_the_pair_loss():
    r = np.random.default_rng(3)
    x, w = r.normal(size=(30, 6)), r.normal(size=6)
    good, bad = r.integers(0, 15, 40), r.integers(15, 30, 40)
    loss, grad = pairwise.pair_loss(w, x, good, bad, 0.1)
    assert np.isclose(loss, np.mean([np.log1p(np.exp(-(x[g] - x[b]) @ w)) for g, b in zip(good, bad)]) + 0.05 * w @ w)
    step = 1e-6
    numeric = [(pairwise.pair_loss(w + step * e, x, good, bad, 0.1)[0] - pairwise.pair_loss(w - step * e, x, good, bad, 0.1)[0]) / (2 * step) for e in np.eye(6)]
    assert np.allclose(grad, numeric, atol=1e-6)


def test_fit_orders_pairs_and_shifts_do_not_matter():
    r = np.random.default_rng(8)
    y = np.repeat([0, 1], 100)
    x = r.normal(size=(200, 3)) + np.outer(y, [3, 0, -2])
    w = pairwise.fit(x, y, pairs=2000)
    s = x @ w
    assert (s[y == 1][:, None] > s[y == 0]).mean() > 0.98
    assert np.allclose(w, pairwise.fit(x + 7, y, pairs=2000))  # only differences count


def test_threshold_is_the_weighted_quantile():
    strength, y = np.array([0.0, 1, 2, 3, 10, 11, 12, 13]), np.array([0, 0, 0, 0, 1, 1, 1, 1])
    assert pairwise.quantile_threshold(strength, y, 0.5) == 6.5
    assert pairwise.quantile_threshold(strength, y, 0.1) == 6.5  # the classes' true shares, whatever the sample's
    mixed = np.array([0.0, 1, 10, 11, 2, 12, 13, 14])  # two bad ones of four look good
    assert pairwise.quantile_threshold(mixed, y, 0.5) == 10.5
    assert pairwise.quantile_threshold(np.array([1.0, 1, 1, 1, 1, 1, 1, 1]), y, 0.5) == 1


def test_held_out_accuracy(spark):
    got = queries.op13_pairwise_quality(spark, LARGER).join(spark.read.parquet(f"{LARGER}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    good = got[got.quality == 1].score.to_numpy()
    bad = got[got.quality == 0].score.to_numpy()
    assert len(bad) > 50
    assert (good[:, None] > bad).mean() > 0.98  # area under the curve
    assert (good >= 0.3).mean() > 0.98 and (bad < 0.3).mean() > 0.93


def test_labels_with_ties_nulls_and_several_texts(spark):
    docs = spark.createDataFrame([(i, f"plain words about number {i}", i) for i in (1, 2, 2, 3, 4)] + [(2, "another text", 0), (None, "none", 0)],
                                 "doc_id bigint, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, None), (4, 1), (None, 1)], "doc_id bigint, quality int")
    held = {r.doc_id for r in docs.filter(queries.toxicity.held_out(F.col("doc_id"))).collect()}
    got = sorted((r.doc_id, r.good) for r in pairwise.labelled(docs, labels).collect())
    assert got == [(i, g) for i, g in [(1, 1), (2, 0), (2, 0), (4, 1)] if i not in held]


def test_awkward_empty_and_unlabelled(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, 0), (3, 0), (4, 1), (6, 0), (7, 1), (-3, 1)], "doc_id bigint, quality int")
    for docs, known in ((awkward(spark), labels), (awkward(spark), labels.limit(0)), (empty(spark), labels)):
        path = scratch_path(spark, "pairwise-input")
        docs.write.parquet(f"{path}/documents.parquet")
        known.write.parquet(f"{path}/labels.parquet")
        got = queries.op13_pairwise_quality(spark, path).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        if known.isEmpty():
            assert {r.score for r in got} == {0.5}
