"""Toxicity by subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is the bag of the character n-grams (``SIZES`` bytes of UTF-8, A-Z lower-cased) of its words, with
word boundaries marked; a hash gives each n-gram one of ``BUCKETS`` embeddings.  The mean embedding of the bag
goes through a linear softmax over {clean, toxic}.  A misspelling that never occurred in training shares
most n-grams with the words it comes from, so it is scored by their vectors.

Training takes every labelled document outside the held-out fold with all n-grams of its text.  The documents are dealt by a
hash of the doc_id into blocks of about ``ROWS``; a task learns embeddings and softmax of its block together by mini-batch
Adagrad and folds them into one weight per bucket.  The weights of all blocks are averaged, each by the count of its rarer class
(a block of one class has nothing to tell apart; its rows count in the share of toxic ones).  The driver gets sums of
weights only, and the model goes to the tasks as a constant-size array; every whole text is then scored in one pass without a
shuffle.  A caller may bound training to ``sample`` rows, half of each class where there are enough; texts with more than
``EXACT`` n-grams then give ``DRAWS`` random draws.

Defined results: a null or empty text, or one without any word, gets the score of the bias alone; without
labelled rows of both classes every score is 0; labels that are null are left out; a doc_id with several labels is toxic if one
of them is, and of several texts under one doc_id training takes the one with the least hash; repeated rows are scored one by one;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import BASE, LOWER_ASCII, Powers, mix, ragged, task_udf, text_chunks

SIZES = (3, 4, 5, 6)
BUCKETS = 1 << 17
DIM = 8
ROWS = 4800    # labelled rows a task learns from
SUMS = 16      # partial sums of weights that reach the driver
EXACT = 1 << 16
DRAWS = 1 << 14
EPOCHS = 8

#: Bytes that are part of words: letters, digits, apostrophe and everything beyond ASCII.
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def ngrams(data: np.ndarray, starts: np.ndarray, power: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every n-gram occurrence of a chunk, in no particular order."""
    n_docs, size = len(starts) - 1, np.diff(starts)
    codes = LOWER_ASCII[data]
    codes = np.where(IN_WORD[codes], codes, np.uint8(32))
    # every document between two separators, so words at its ends have boundaries too
    stream = np.full(len(data) + n_docs + 1, 32, np.uint8)
    shift = np.arange(1, n_docs + 1)
    stream[ragged(starts[:-1] + shift, size)] = codes
    doc = np.repeat(np.arange(n_docs), size + 1)
    gap = stream == 32
    gaps = np.append(0, np.cumsum(gap))
    up, down = power.get(len(stream) + 1)
    total = np.zeros(len(stream) + 1, np.uint64)
    np.cumsum((stream.astype(np.uint64) + np.uint64(7)) * up[:-1], out=total[1:])
    docs, buckets = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for n in SIZES:
        last = len(stream) - n + 1
        if last <= 0:
            continue
        at = np.flatnonzero(gaps[n - 1:n - 1 + last] == gaps[1:1 + last])  # no boundary inside
        hashed = mix((total[at + n] - total[at]) * down[at] + np.uint64((n * BASE) & ((1 << 64) - 1)))
        docs.append(doc[at])
        buckets.append((hashed & np.uint64(BUCKETS - 1)).astype(np.int64))
    return np.concatenate(docs), np.concatenate(buckets)


def _counts(text: pa.Array, exact: int | None = EXACT) -> pa.Array:
    """Per text, its n-gram buckets and how often each occurs, or was drawn if there are more than ``exact`` (None: never drawn)."""
    power, bucket, count, size = Powers(), [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
    for _, _, data, starts in text_chunks(text):
        doc, b = ngrams(data, starts, power)
        key, c = np.unique(doc * BUCKETS + b, return_counts=True)
        total = np.bincount(doc, minlength=len(starts) - 1)
        for d in np.flatnonzero(total > exact).tolist() if exact else []:
            i, j = np.searchsorted(key, [d * BUCKETS, (d + 1) * BUCKETS])
            c[i:j] = np.random.default_rng(int(total[d])).multinomial(DRAWS, c[i:j] / total[d])
        key, c = key[c > 0], c[c > 0]
        bucket.append(key % BUCKETS)
        count.append(c)
        size.append(np.bincount(key // BUCKETS, minlength=len(starts) - 1))
    at = pa.array(np.cumsum(np.concatenate(size)).astype(np.int32))
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(at, pa.array(np.concatenate(bucket).astype(np.int32))),
         pa.ListArray.from_arrays(at, pa.array(np.concatenate(count).astype(np.int32)))], ["bucket", "count"])


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that training never sees: crc32 of the doc_id as text divisible by ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labelled documents of ``docs`` outside the held-out fold; moves ids only."""
    seen = (labels.select("doc_id", "toxic").filter("toxic is not null and doc_id is not null")
            .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    return seen.join(docs.filter("text is not null").select("doc_id"), "doc_id", "left_semi")


def training_rows(docs: DataFrame, labels: DataFrame, sample: int | None = None, blocks: int = 1) -> DataFrame:
    """The labelled texts (doc_id, toxic, text) in ``blocks`` partitions by doc_id; at most ``sample`` of them if one is given,
    half of each class where there are enough."""
    seen = labelled(docs, labels)
    if sample:
        half = [seen.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample // 2) for k in (0, 1)]
        seen = half[0].union(half[1])
    texts = docs.select("doc_id", "text").filter("text is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    # labels and texts move once, as one table: a join would deal them out by the session's shuffle partitions instead of by blocks
    both = texts.withColumn("toxic", F.lit(None)).unionByName(seen.withColumn("text", F.lit(None)))
    first = F.min_by("text", F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    rows = both.repartition(blocks, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), first.alias("text"))
    return rows.filter("toxic is not null and text is not null")


class Model:
    """Embeddings and softmax; ``weights`` folds both into one number per bucket."""

    def __init__(self, dim: int = DIM, buckets: int = BUCKETS, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.embedding = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
        self.out = np.zeros((dim, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def fit(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS,
            rate: float = 0.5, batch: int = 32, seed: int = 12) -> "Model":
        """``bags``: per text its buckets and counts.  Texts without n-grams are left out."""
        rng = np.random.default_rng(seed)
        squares = [np.full_like(x, 1e-6) for x in (self.embedding, self.out, self.bias)]
        rows = np.array([i for i, (b, _) in enumerate(bags) if len(b)], np.int64)
        shares = [(c / max(c.sum(), 1)).astype(np.float32) for _, c in bags]
        for _ in range(epochs):
            rng.shuffle(rows)
            for low in range(0, len(rows), batch):
                picked = rows[low:low + batch]
                mean = np.stack([shares[i] @ self.embedding[bags[i][0]] for i in picked])
                logit = mean @ self.out + self.bias
                p = np.exp(logit - logit.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                p[np.arange(len(picked)), labels[picked]] -= 1
                # with two classes the pull on an embedding is a number times the difference of the outputs
                pull = np.bincount(np.concatenate([bags[i][0] for i in picked]),
                                   np.concatenate([shares[i] * x for i, x in zip(picked, p[:, 1])]), len(self.embedding))
                used = np.flatnonzero(pull)
                grad = (pull[used, None] * (self.out[:, 1] - self.out[:, 0])).astype(np.float32)
                for value, square, g, at in ((self.embedding, squares[0], grad, used), (self.out, squares[1], mean.T @ p, slice(None)),
                                             (self.bias, squares[2], p.sum(axis=0), slice(None))):
                    square[at] += g * g
                    value[at] -= rate * g / np.sqrt(square[at])
        return self

    def weights(self) -> tuple[np.ndarray, float]:
        step = self.out[:, 1] - self.out[:, 0]
        return (self.embedding @ step).astype(np.float32), float(self.bias[1] - self.bias[0])


def _learn(exact: int | None):
    """Task that learns from the rows of its block: weights and bias times the count of its rarer class, and that count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, y, bags = [], [], []
        for rows in batches:
            ids += rows.column("doc_id").to_pylist()
            y += rows.column("toxic").to_pylist()
            counts = _counts(rows.column("text"), exact)
            bags += [(b.values.to_numpy().copy(), c.values.to_numpy().copy()) for b, c in zip(counts.field("bucket"), counts.field("count"))]
        order = np.argsort(np.array(ids, object), kind="stable")  # whatever order the rows came in
        y = np.array(y, np.int64)[order]
        n = int(min(y.sum(), len(y) - y.sum()))
        if n:
            weights, bias = Model().fit([bags[i] for i in order], y).weights()
            bias -= np.log(y.mean() / (1 - y.mean()))  # as if both classes were equally frequent
            yield pa.record_batch([pa.array([(weights.astype(np.float64) * n).tobytes()], pa.binary()), pa.array([bias * n]), pa.array([n], pa.int64())],
                                  ["weights", "bias", "n"])
    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the sums of a task's rows."""
    weights, bias, n = np.zeros(BUCKETS), 0.0, 0
    for rows in batches:
        for w in rows.column("weights"):
            weights += np.frombuffer(w.as_buffer(), np.float64)
        bias, n = bias + sum(rows.column("bias").to_pylist()), n + sum(rows.column("n").to_pylist())
    if n:
        yield pa.record_batch([pa.array([weights.tobytes()], pa.binary()), pa.array([bias]), pa.array([n], pa.int64())], ["weights", "bias", "n"])


def train(docs: DataFrame, labels: DataFrame, sample: int | None = None) -> tuple[np.ndarray, float]:
    """Weight per bucket and bias, learnt from all labelled rows outside the held-out fold (or from ``sample`` of them)."""
    share = labelled(docs, labels).agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    if not share.toxic or share.toxic == share.n:
        return np.zeros(BUCKETS, np.float32), -np.inf
    blocks = -(-min(share.n, sample or share.n) // ROWS)
    learnt = training_rows(docs, labels, sample, blocks).select("doc_id", "toxic", "text").mapInArrow(
        _learn(EXACT if sample else None), "weights binary, bias double, n bigint")
    sums = learnt.repartition(min(SUMS, blocks)).mapInArrow(_added, learnt.schema).collect()
    n = sum(r.n for r in sums)
    if not n:
        return np.zeros(BUCKETS, np.float32), -np.inf
    weights = sum(np.frombuffer(r.weights, np.float64) for r in sums) / n
    return weights.astype(np.float32), sum(r.bias for r in sums) / n + float(np.log(share.toxic / (share.n - share.toxic)))


def score(text: Column, weights: np.ndarray, bias: float) -> Column:
    """Probability that a whole text is toxic."""
    def run(column: pa.Array) -> pa.Array:
        power, out = Powers(), [np.empty(0, np.float64)]
        for _, _, data, starts in text_chunks(column):
            doc, bucket = ngrams(data, starts, power)
            n = len(starts) - 1
            total = np.bincount(doc, weights=weights[bucket], minlength=n)
            out.append(total / np.maximum(np.bincount(doc, minlength=n), 1))
        margin = np.clip(np.concatenate(out) + bias, -50, 50) if np.isfinite(bias) else np.full(len(column), -np.inf)
        return pa.array(1 / (1 + np.exp(-margin)))

    return task_udf(run, "double")(text)
