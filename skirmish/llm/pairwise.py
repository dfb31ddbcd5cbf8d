"""Quality classifier by Bradley-Terry pairwise ranking.

A document has a strength ``s(x) = w . features(x)``, and a labelled good document beats a labelled bad one with probability
``sigmoid(s(good) - s(bad))``.  The weights are learnt by logistic loss on the feature differences of preference pairs (good,
bad); only differences count, so the strengths have no zero of their own.  The zero is set afterwards: the threshold is the
quantile of the strengths of all labelled documents at the labelled share of bad ones, and a document on it scores ``AT_THRESHOLD``.

Features of a whole text, none of them a count that grows with its length:

* the share of every shape trigram: bytes fall into 16 classes (small letter, capital, digit, blank, line end, groups of marks,
  ...), three consecutive classes are one of 4096 trigrams;
* figures of words and lines (``DENSE``): length, word length, repeated lines and windows, variety, single characters, lines.

Training takes every labelled text outside the held-out fold, dealt by a hash of the doc_id into blocks of about ``ROWS``.  A task
learns the weights of its block; those of all blocks are averaged, each by the count of its rarer class.  The threshold
is read from the strengths of all labelled texts, numbered by range partitions.  The model is one weight per trigram and per
figure, a constant-size array that goes to the tasks; every whole text is scored in one pass without a shuffle.

Defined results: a null or empty text, or one without any word, has the figures of an empty text and is scored by them; without
labelled rows of both classes every score is 0.5; labels that are null are left out; a doc_id with several labels takes the
smallest; of several texts under one doc_id each is a row of its own, equal ones count once in training; repeated rows are scored
one by one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import range_row_number
from .arrays import Powers, segment_sums, span_hashes, task_udf, text_chunks, window_hashes, word_spans
from .toxicity import held_out

ROWS = 4000    # labelled rows a task learns from
SUMS = 16      # partial sums of weights that reach the driver
PAIRS = 20000
STEPS = 300
RATE = 0.1
DECAY = 1e-3
AT_THRESHOLD = 0.3
SHAPES = 4096
DENSE = ("log_words", "word_length", "dup_lines", "repeat_words", "variety", "single", "lines")


def shape_classes() -> np.ndarray:
    """Class of every byte, 0 to 15."""
    out = np.full(256, 13, np.uint8)  # other ASCII
    out[128:192], out[192:] = 15, 14   # inside and beginning of a longer character
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".,;:",
                               b"!", b"?", b"|", b"#*$%&", b"<>{}[]()", b"'\"`", b"-_~=+/\\")):
        out[list(chars)] = k
    return out


def shapes(data: np.ndarray, starts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(trigram of every position that has one, positions per document as bounds)."""
    kind = classes[data].astype(np.int64)
    per_doc = np.maximum(np.diff(starts) - 2, 0)
    code = kind[:-2] * 256 + kind[1:-1] * 16 + kind[2:] if len(kind) > 2 else np.empty(0, np.int64)
    inside = np.ones(len(code), bool)
    for back in (1, 2):  # a trigram does not cross into the next document
        at = starts[1:-1] - back
        inside[at[(at >= 0) & (at < len(code))]] = False
    return code[inside], np.append(0, np.cumsum(per_doc))


def figures(data: np.ndarray, starts: np.ndarray, power: Powers) -> np.ndarray:
    """``DENSE`` figures, one row per document."""
    n_docs = len(starts) - 1
    begin, end, first = word_spans(data, starts)
    n = np.diff(first).astype(np.float64)
    some = np.maximum(n, 1)
    doc = np.repeat(np.arange(n_docs), np.diff(first))
    lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    length = (lead[end] - lead[begin]).astype(np.int64)
    words = span_hashes(data, begin, end, power)

    def distinct(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
        order = np.lexsort((hashes, of))
        h, d = hashes[order], of[order]
        return np.bincount(d[np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))] if len(d) else d, minlength=n_docs)

    window, at, bounds = window_hashes(words, first, 5)
    of = np.repeat(np.arange(n_docs), np.diff(bounds))
    order = np.lexsort((window, of))
    again = np.zeros(len(window), bool)
    again[1:] = (window[order][1:] == window[order][:-1]) & (of[order][1:] == of[order][:-1])
    repeated = np.bincount(of[order][again], minlength=n_docs)
    line_begin = np.union1d(starts[:-1], np.flatnonzero(data == 10) + 1)
    line_begin = line_begin[line_begin < len(data)]
    line_end = np.append(line_begin[1:], len(data))[:len(line_begin)]
    full = np.searchsorted(begin, line_end) > np.searchsorted(begin, line_begin)
    line_begin, line_end = line_begin[full], line_end[full]
    line_end = line_end - (data[line_end - 1] == 10) if len(line_end) else line_end
    line_doc = np.searchsorted(starts, line_begin, "right") - 1
    lines = np.bincount(line_doc, minlength=n_docs).astype(np.float64)
    same = lines - distinct(span_hashes(data, line_begin, line_end, power), line_doc)
    return np.column_stack([
        np.log1p(n), segment_sums(length, first) / some, same / np.maximum(lines, 1), repeated / some,
        np.log1p(distinct(words, doc)) / np.log1p(some), segment_sums((length == 1).astype(np.int64), first) / some, lines / some])


def _features(text: pa.Array) -> pa.Array:
    """Per text, its trigrams, how often each occurs, and the figures."""
    power, classes = Powers(), shape_classes()
    code, count, size, dense = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.zeros(1, np.int64)], [np.empty((0, len(DENSE)))]
    for _, _, data, starts in text_chunks(text):
        c, bounds = shapes(data, starts, classes)
        key, n = np.unique(np.repeat(np.arange(len(starts) - 1), np.diff(bounds)) * SHAPES + c, return_counts=True)
        code.append(key % SHAPES)
        count.append(n)
        size.append(np.bincount(key // SHAPES, minlength=len(starts) - 1))
        dense.append(figures(data, starts, power))
    at, flat = pa.array(np.cumsum(np.concatenate(size)).astype(np.int32)), np.concatenate(dense)
    return pa.StructArray.from_arrays(
        [pa.ListArray.from_arrays(at, pa.array(np.concatenate(code).astype(np.int32))),
         pa.ListArray.from_arrays(at, pa.array(np.concatenate(count).astype(np.int64))),
         pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, len(DENSE), dtype=np.int32)), pa.array(flat.reshape(-1)))],
        ["code", "count", "dense"])


FEATURES = "struct<code:array<int>,count:array<bigint>,dense:array<double>>"


def known(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of the labelled ids outside the held-out fold."""
    return (labels.filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("quality").cast("int").alias("good")))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text_hash, good) of the distinct labelled texts outside the held-out fold; moves ids and hashes only."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash")).join(known(labels), "doc_id").distinct()


def training_rows(docs: DataFrame, labels: DataFrame, blocks: int = 1) -> DataFrame:
    """The ``labelled`` rows with their texts, in ``blocks`` partitions by doc_id."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    # the texts move once: join and distinct both take the rows where their block is
    texts = texts.repartition(blocks, "doc_id").join(known(labels).repartition(blocks, "doc_id"), "doc_id")
    return texts.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "good", "text")


def pair_loss(weights: np.ndarray, x: np.ndarray, good: np.ndarray, bad: np.ndarray, decay: float) -> tuple[float, np.ndarray]:
    """Mean logistic loss of the preference pairs (rows good over rows bad) with weight decay, and its gradient."""
    strength = x @ weights
    margin = strength[good] - strength[bad]
    loss = np.logaddexp(0, -margin).mean() + decay / 2 * weights @ weights
    pull = -1 / (1 + np.exp(np.clip(margin, -50, 50))) / len(margin)
    per_row = np.bincount(good, pull, len(x)) - np.bincount(bad, pull, len(x))
    return float(loss), x.T @ per_row + decay * weights


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, rate: float = RATE, decay: float = DECAY, seed: int = 5) -> np.ndarray:
    """Bradley-Terry weights of the columns of ``x`` from random preference pairs of ``y`` = 1 over ``y`` = 0, by Adagrad."""
    rng = np.random.default_rng(seed)
    good, bad = (rng.choice(np.flatnonzero(y == k), pairs) for k in (1, 0))
    weights, squares = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-6)
    for _ in range(steps):
        _, grad = pair_loss(weights, x, good, bad, decay)
        squares += grad * grad
        weights -= rate * grad / np.sqrt(squares)
    return weights


def quantile_threshold(strength: np.ndarray, y: np.ndarray, bad_share: float) -> float:
    """Strength below which ``bad_share`` of the labelled documents lie; the sample's classes are weighted to their true shares.

    Between the two neighbouring strengths the threshold stands in the middle.
    """
    weight = np.where(y == 0, bad_share / (y == 0).sum(), (1 - bad_share) / (y == 1).sum())
    order = np.argsort(strength, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), bad_share - 1e-9)) + 1
    ranked = strength[order]
    return float(ranked[below - 1] + ranked[min(below, len(ranked) - 1)]) / 2


class Model:
    """Weight per trigram and per figure, and the constant that puts the threshold at ``AT_THRESHOLD``."""

    def __init__(self, shape: np.ndarray, dense: np.ndarray, constant: float):
        self.shape, self.dense, self.constant = shape, dense, constant


def learnt(shares: np.ndarray, dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of trigrams and figures from trigram shares and figures (a row per document) and labels."""
    used = np.flatnonzero(np.append(shares.any(axis=0), np.ones(dense.shape[1], bool)))  # the others keep the weight 0
    x = np.hstack([shares[:, used[:-dense.shape[1]]], dense])
    spread = np.maximum(x.std(axis=0), 1e-3)
    weights = np.zeros(SHAPES + dense.shape[1])
    weights[used] = fit((x - x.mean(axis=0)) / spread, y) / spread
    return weights


SUMMED = "weights array<double>, n bigint"


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The weights that the rows of a block teach, times the count of its rarer class, and that count."""
    ids, y, shares, dense = [], [], [], []
    for rows in batches:
        ids += zip(rows.column("doc_id").to_pylist(), rows.column("text_hash").to_pylist())
        y += rows.column("good").to_pylist()
        found = _features(rows.column("text"))
        share = np.zeros((rows.num_rows, SHAPES), np.float32)
        for r, (code, count) in enumerate(zip(found.field("code"), found.field("count"))):
            if len(code):
                c = count.values.to_numpy()
                share[r, code.values.to_numpy()] = c / c.sum()
        shares.append(share)
        dense.append(np.array(found.field("dense").to_pylist(), np.float64).reshape(-1, len(DENSE)))
    y = np.array(y, np.int64)
    n = int(min(y.sum(), len(y) - y.sum()))
    if n:
        order = sorted(range(len(ids)), key=ids.__getitem__)  # whatever order the rows came in
        weights = learnt(np.concatenate(shares)[order], np.concatenate(dense)[order], y[order])
        yield pa.record_batch([pa.array([(weights * n).tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["weights", "n"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the sums of a task's rows."""
    weights, n = np.zeros(SHAPES + len(DENSE)), 0
    for rows in batches:
        for w, k in zip(rows.column("weights"), rows.column("n").to_pylist()):
            weights, n = weights + w.values.to_numpy(), n + k
    if n:
        yield pa.record_batch([pa.array([weights.tolist()], pa.list_(pa.float64())), pa.array([n], pa.int64())], ["weights", "n"])


def threshold(strengths: DataFrame, bad: int) -> float:
    """``quantile_threshold`` of all rows of ``strengths`` (strength), of which ``bad`` are bad: between the ``bad``-th and the next."""
    ranked = range_row_number(strengths.select("strength"), [], ["strength"]).filter(F.col("rn").between(bad, bad + 1))
    near = sorted(r.strength for r in ranked.collect())  # two rows
    return (near[0] + near[-1]) / 2


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model of all labelled rows outside the held-out fold; None unless both classes occur."""
    n = {r.good: r["count"] for r in labelled(docs, labels).groupBy("good").count().collect()}  # two rows
    if not n.get(0) or not n.get(1):
        return None
    blocks = -(-sum(n.values()) // ROWS)
    parts = training_rows(docs, labels, blocks).mapInArrow(_learn, SUMMED).repartition(min(SUMS, blocks)).mapInArrow(_added, SUMMED).collect()
    total = sum(r.n for r in parts)
    if not total:
        return None
    weights = sum(np.array(r.weights) for r in parts) / total
    model = Model(weights[:SHAPES], weights[SHAPES:], 0.0)
    texts = docs.filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), strength(F.col("text"), model).alias("strength"))
    seen = texts.join(known(labels), "doc_id").groupBy("doc_id", "text_hash").agg(F.min("strength").alias("strength"))
    model.constant = float(np.log(AT_THRESHOLD / (1 - AT_THRESHOLD)) - threshold(seen, n[0]))
    return model


def strength(text: Column, model: Model) -> Column:
    """Strength of a whole text, its constant included."""
    def run(column: pa.Array) -> pa.Array:
        power, classes, out = Powers(), shape_classes(), [np.empty(0)]
        for _, _, data, starts in text_chunks(column):
            code, bounds = shapes(data, starts, classes)
            mean = segment_sums(model.shape[code], bounds) / np.maximum(np.diff(bounds), 1)
            out.append(mean + figures(data, starts, power) @ model.dense + model.constant)
        return pa.array(np.concatenate(out))

    return task_udf(run, "double")(text)


def score(text: Column, model: Model | None) -> Column:
    """Quality of a whole text between 0 and 1; ``AT_THRESHOLD`` stands at the threshold."""
    if model is None:
        return F.lit(0.5)
    return 1 / (1 + F.exp(-F.greatest(F.least(strength(text, model), F.lit(50.0)), F.lit(-50.0))))
