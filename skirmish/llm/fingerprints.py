"""Document fingerprints by locally consistent parsing with deterministic coin tossing.

A text is a sequence of names (at first its code points).  One round replaces it by a shorter sequence:

1. a run of equal names becomes one name (of the name and the run's length), so neighbours differ;
2. deterministic coin tossing labels each name with the lowest bit in which it differs from the name
   before it, and that bit; four iterations bring any 64-bit alphabet down to six labels on which
   neighbours still differ, and three recolourings down to three;
3. a phrase begins at each local maximum of the labels (and at the start of the text), so phrases have
   two to four names; a phrase is named by a hash of its names.

Where a phrase begins depends only on a few names to its left and right.  Equal substrings therefore get
the same phrases, except near their ends, at whatever offset they stand, and by induction the same names
on every level.  Rounds go on until a text has come down to two phrases, so the number of levels follows its length.  From level
2 on the fingerprint keeps, per level, the ``KEEP`` smallest hashes of the distinct phrases and every hash in the lowest
1 / ``RATE`` of the range (1 / ``HIGH_RATE`` from level 4 on), so it grows with the text; a level of at most ``KEEP`` phrases is whole.
Below the largest hash that both fingerprints keep for sure, both are complete, and the shares computed there are unbiased.

* likeness: mean over ``LEVELS`` of the share of common phrases;
* reach: mean length in code points of a phrase of the highest level on which both have one in common, 0 for none: about the size of the
  longest passage that both share, also where it is a small part of long texts.

Defined results: the empty (or null) text has an empty fingerprint, alike (1) only to another empty one;
equal texts have equal fingerprints; repeated rows follow one another; null doc_ids come last, all of them in the range of the
least ids; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import mix, task_udf

LEVELS = (2, 3)
KEEP = 48
RATE = 16
HIGH_RATE = 4
CHUNK_CHARS = 1 << 17

DIGEST = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
         "near_edited double, near_next double, reach_edited bigint, reach_next bigint"


def toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Label of each name: position of the lowest bit unlike the name before it, and that bit of the name."""
    before = np.empty_like(x)
    before[1:] = x[:-1]
    before[first] = ~x[first]
    low = x ^ before
    low &= -low
    place = (low.astype(np.float64).view(np.uint64) >> np.uint64(52)) - np.uint64(1023)  # exponent of a power of two
    return ((place << np.uint64(1)) | ((x & low) != 0)) & np.uint64(127)


def toss_table(bits: int) -> np.ndarray:
    """The same for small labels, as a table over (label before, label)."""
    n = 1 << bits
    before, x = np.meshgrid(np.arange(n), np.arange(n), indexing="ij")
    low = (x ^ before) & -(x ^ before)
    return (2 * np.log2(np.maximum(low, 1)).astype(np.int64) + ((x & low) != 0)).astype(np.uint8)


TOSS = {b: toss_table(b) for b in (7, 4, 3)}


def round_of(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One round of parsing: names of the phrases and the first phrase of each document (+ total)."""
    n = len(names)
    if n == 0:
        return names, starts
    # runs
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    inner = starts[:-1][starts[:-1] < n]
    new[inner] = True
    at = np.flatnonzero(new)
    if len(at) < n:
        length = np.diff(at, append=n)
        names = names[at]
        many = length > 1
        names[many] = mix(names[many] + length[many].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        starts = np.searchsorted(at, starts)
        n = len(names)
    first = starts[:-1][np.diff(starts) > 0]
    label = toss(names, first).astype(np.uint8)
    for bits in (7, 4, 3):
        before = np.empty_like(label)
        before[1:] = label[:-1]
        before[first] = label[first] ^ 1
        label = TOSS[bits][before, label]
    # six labels to three: the smallest colour that neither neighbour has
    padded = np.full(n + 2, 9, np.uint8)
    padded[1:-1] = label
    edge = np.zeros(n + 1, bool)  # a document ends before position i
    edge[first] = True
    edge[n] = True
    for colour in (3, 4, 5):
        i = np.flatnonzero(padded[1:-1] == colour)
        left = np.where(edge[i], 9, padded[i])
        right = np.where(edge[i + 1], 9, padded[i + 2])
        free = np.where((left != 0) & (right != 0), 0, np.where((left != 1) & (right != 1), 1, 2))
        padded[i + 1] = free
    label = padded[1:-1].astype(np.int8)
    left, right = np.empty_like(label), np.empty_like(label)
    left[1:], right[:-1] = label[:-1], label[1:]
    left[first] = 9  # the start of a document begins a phrase anyway
    right[edge[1:]] = -1
    cut = (label > left) & (label > right)
    cut[first] = True
    begin = np.flatnonzero(cut)
    size = np.diff(begin, append=n)
    total = size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for k in range(int(size.max())):
        there = np.flatnonzero(size > k)
        total[there] += names[begin[there] + k] * np.uint64((0x165667B19E3779F9 * (2 * k + 3) ** 5 | 1) & ((1 << 64) - 1))
    return mix(total), np.searchsorted(begin, starts)


def limit_of(level: int) -> int:
    """Hashes below it are kept, however many."""
    return (1 << 32) // (RATE if level < 4 else HIGH_RATE)


def smallest(names: np.ndarray, starts: np.ndarray, keep: int, limit: int) -> list[np.ndarray]:
    """Per document, its ``keep`` smallest distinct 32-bit hashes and all below ``limit``, sorted."""
    doc = np.repeat(np.arange(len(starts) - 1, dtype=np.uint64), np.diff(starts))
    key = np.sort(doc << np.uint64(32) | names >> np.uint64(32))
    key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
    docs = np.arange(len(starts), dtype=np.uint64) << np.uint64(32)
    bounds = np.searchsorted(key, docs)
    ends = np.minimum(bounds[1:], np.maximum(bounds[:-1] + keep, np.searchsorted(key, docs[:-1] + np.uint64(limit))))
    low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [low[a:b] for a, b in zip(bounds[:-1].tolist(), ends.tolist())]


def sketches(texts: list[str], keep: int = KEEP) -> list[tuple[np.ndarray, ...]]:
    """Per text, the phrase hashes kept of each level from 2 on."""
    out, i = [], 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK_CHARS):
            size, j = size + len(texts[j]), j + 1
        codes = np.frombuffer("".join(texts[i:j]).encode("utf-32-le"), np.uint32).astype(np.uint64)
        names = mix(codes + np.uint64(1))
        starts = np.append(0, np.cumsum([len(t) for t in texts[i:j]]))
        found: list[list[np.ndarray]] = [[] for _ in texts[i:j]]
        open_, level = np.arange(j - i), 1  # texts that have not come down to two phrases yet
        while len(open_):
            names, starts = round_of(names, starts)
            if level > 1:
                for d, kept in zip(open_.tolist(), smallest(mix(names + np.uint64(level)), starts, keep, limit_of(level))):
                    found[d].append(kept)
            if level >= max(LEVELS):
                size_of = np.diff(starts)
                more = size_of > 2
                if not more.all():
                    names, starts, open_ = names[np.repeat(more, size_of)], np.append(0, np.cumsum(size_of[more])), open_[more]
            level += 1
        out += [tuple(f) for f in found]
        i = j
    return out


def known_below(x: np.ndarray, keep: int, limit: int) -> int:
    """Below this hash the sketch of a level holds every hash of the text."""
    return 1 << 32 if len(x) < keep else max(int(x[-1]) + 1, limit)


def alike(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], keep: int = KEEP) -> float:
    """Likeness of two sketches, 0 to 1."""
    shares = []
    for level, x, y in zip(LEVELS, a, b):
        bound = min(known_below(x, keep, limit_of(level)), known_below(y, keep, limit_of(level)))
        x, y = x[:np.searchsorted(x, bound)], y[:np.searchsorted(y, bound)]
        common = len(np.intersect1d(x, y, True))
        union = len(x) + len(y) - common
        shares.append(common / union if union else 1.0)
    return float(np.mean(shares))


def reach(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], chars: int, keep: int = KEEP) -> int:
    """Mean length of a phrase of ``a`` (a text of ``chars`` code points) on the highest level with a common phrase."""
    for level in range(min(len(a), len(b)), 0, -1):
        x, y = a[level - 1], b[level - 1]
        common = len(np.intersect1d(x, y, True))
        if common > 4 * len(x) * len(y) / 2 ** 32:  # more than equal hashes of unequal phrases explain
            phrases = len(x) * 2 ** 32 / known_below(x, keep, limit_of(level + 1))
            return min(chars, round(chars / max(phrases, 1)))
    return 0


def spelled(sketch: tuple[np.ndarray, ...]) -> str:
    """Fingerprint string: the hashes of each level in hexadecimal, levels joined by a colon; empty for no text."""
    return ":".join(x.astype(">u4").tobytes().hex() for x in sketch) if any(len(x) for x in sketch) else ""


def parsed(fingerprint: str) -> tuple[np.ndarray, ...]:
    if not fingerprint:
        return (np.empty(0, np.uint32),) * len(LEVELS)
    return tuple(np.frombuffer(bytes.fromhex(p), ">u4").astype(np.uint32) for p in fingerprint.split(":"))


def fingerprint(text: Column) -> Column:
    """Fingerprint string of every whole text."""
    def run(column: pa.Array) -> pa.Array:
        return pa.array([spelled(s) for s in sketches([t or "" for t in column.to_pylist()])], pa.string())

    return task_udf(run, "string")(text)


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprint strings."""
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array([alike(parsed(p or ""), parsed(q or "")) for p, q in zip(x.to_pylist(), y.to_pylist())], pa.float64())

    return task_udf(run, "double")(a, b)


def edited(text: str, following: str) -> str:
    """The last third of ``text`` replaced by as much of the beginning of the following text (or all of it)."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (bucket, borrowed, doc_id, text) in ranges of doc_id, each range followed by the first row of the next.

    Ranges come from approximate quantiles of doc_id (a bounded list on the driver); each document crosses
    the network once, and the largest id of a range once more as the end of the range above it.  Within a range the
    order is descending doc_id (null last).  After the last document comes the first.
    """
    spark = docs.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [k / ranges for k in range(1, ranges)]
    cuts, top = docs.agg(F.percentile_approx("doc_id", at, 20 * ranges), F.max("doc_id")).first()
    heads = np.unique(np.array([*(cuts or []), *([] if top is None else [top])], np.int64))

    def places(doc_id: pa.Array) -> pa.Array:
        """Ranges of a row: its own, and that above it (as a borrowed row) if it is the largest id of its own."""
        known = ~np.array(doc_id.is_null())
        ids = doc_id.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
        own = np.searchsorted(heads, ids) if len(heads) else np.zeros(len(ids), np.int64)
        # without any doc_id there is one range, and every row may be the one that follows the last
        lent = known & (heads[np.minimum(own, len(heads) - 1)] == ids) if len(heads) else np.ones(len(ids), bool)
        count = 1 + lent
        offsets = np.append(0, np.cumsum(count))
        bucket, extra = np.zeros(offsets[-1], np.int64), np.zeros(offsets[-1], bool)
        bucket[offsets[:-1]] = own
        second = offsets[:-1][lent] + 1
        bucket[second], extra[second] = (own[lent] + 1) % max(len(heads), 1), True
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(
            [pa.array(bucket), pa.array(extra)], ["bucket", "borrowed"]))

    udf = task_udf(places, "array<struct<bucket:bigint,borrowed:boolean>>")
    rows = docs.select(F.explode(udf(F.col("doc_id"))).alias("p"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("p.bucket", "p.borrowed", "doc_id", "text")
    return rows.repartition(ranges // 4, "bucket").sortWithinPartitions(
        "bucket", "borrowed", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), "text")


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text and of its edited text, with likeness to that and to the next document."""
    def run(batches):
        held = None  # the last row of the batch before, whose following row is not known yet
        for batch in batches:
            rows = list(zip(*(batch.column(k).to_pylist() for k in range(4))))
            rows = [held, *rows] if held else rows
            # borrowed rows only serve the last row of their own range; the first of them counts
            rows = [r for k, r in enumerate(rows) if not (r[1] and k and rows[k - 1][1] and rows[k - 1][0] == r[0])]
            if not rows:
                continue
            held = rows[-1]
            mine = [k for k in range(len(rows) - 1) if not rows[k][1]]
            for low in range(0, len(mine), 500):
                yield judged(rows, mine[low:low + 500])

    def judged(rows: list, mine: list[int]) -> pa.RecordBatch:
        texts = [rows[k][3] for k in mine]
        after = [rows[k + 1][3] for k in mine]
        changed = [edited(t, a) for t, a in zip(texts, after)]
        sketch = sketches(texts)
        # the next row of a row is mostly the following one of the list, already sketched
        extra = [i for i, k in enumerate(mine) if i + 1 == len(mine) or mine[i + 1] != k + 1]
        follow = sketch[1:] + [None]
        for i, s in zip(extra, sketches([after[i] for i in extra])):
            follow[i] = s
        second = sketches(changed)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[k][2] for k in mine], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([spelled(s) for s in sketch], pa.string()), pa.array([spelled(s) for s in second], pa.string()),
            pa.array([alike(a, b) for a, b in zip(sketch, second)], pa.float64()),
            pa.array([alike(a, b) for a, b in zip(sketch, follow)], pa.float64()),
            pa.array([reach(a, b, len(t)) for a, b, t in zip(sketch, second, texts)], pa.int64()),
            pa.array([reach(a, b, len(t)) for a, b, t in zip(sketch, follow, texts)], pa.int64())],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "reach_edited", "reach_next"])

    return with_next(docs).mapInArrow(run, DIGEST)
