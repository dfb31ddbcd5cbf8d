"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star-shaped edges.

A document is the set of its distinct 5-word shingles (A-Z lower-cased); with fewer words its whole word
sequence is one shingle; without words it has no shingle and no link.  Two documents are linked when
``100 * |intersection| >= percent * |union|``; the result is the connected components of the links.

1. One pass over the texts hashes every shingle once.  The hash range is cut into ``BANDS * ROWS`` bins;
   a bin holds the smallest hash that falls into it (one-permutation hashing) and an empty bin borrows
   from a bin picked by its own random order of the bins (optimal densification).  Each band of ``ROWS``
   bins gives one bucket key.  At a similarity of 0.85 a pair shares no bucket with probability
   (1 - 0.85 ** ROWS) ** BANDS, about 3e-7 for 6 x 32 (6e-5 at 0.8).
2. Equal sets collapse to one class before anything is paired, so exact copies cost one aggregation,
   however many there are.  Classes get numbers; the graph is one of classes, whatever doc_ids their rows have.
3. Each bucket names one centre and gives one edge per other member: a star, never all pairs.  The edges
   are confirmed on the full shingle sets; confirmed ones are links.
4. A star loses a link between two members that are both unlike the centre.  So buckets whose members
   are still in different components after step 3 are taken up again.  Small ones are compared in
   blocks of bounded size, inside the task, which returns a spanning forest of the links, not pairs.  In larger ones members
   meet only if they share one of their rarest shingles: two sets of the wanted similarity must share one of the first
   n - ceil(0.85 n) + 1 shingles in the order of their frequency in the bucket.  So a passage that a million
   documents have in common brings none of them together.  Every pair that shares a bucket has then been confirmed,
   is connected already or cannot be alike, without a cap on buckets or partners.

Buckets, components and classes that hold more than a hundredth of the rows at hand are found by a sketch and joined by broadcast,
where their rows are, so no task gathers them.

Links, labels and sets stay distributed tables; the driver sees only loop counters.  Intermediate
tables go to the folder of ``spark.checkpoint.dir``.

Defined results: null text is empty; every row is judged by its text, also those that share a doc_id or have
none; component_id is the smallest doc_id of the group (null if no row has one), and ``components`` marks the rows with that
doc_id as kept.  ``keep_one`` keeps one row: that with the smallest (doc_id, hash of doc_id and text), null doc_ids last; rows
equal in both are one document.  Rows without words have no links and are kept with their own doc_id; an empty table gives an empty
table; ``components`` ignores other columns, ``keep_one`` keeps them as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import heavy_keys, join_heavy
from ..session import materialize
from .arrays import LOWER_ASCII, Powers, mix, segment_sums, span_hashes, task_udf, text_chunks, window_hashes, word_spans

WIDTH = 5
ROWS = 6
BANDS = 32
PERCENT = 85
BLOCK = 384
LARGE = 64  # blocks; in larger buckets members meet by rare shingles, which moves a set once per rare shingle and not once per block

SIGNATURE = "struct<n:bigint,h1:bigint,h2:bigint,bands:array<bigint>>"


def shingle_sets(data: np.ndarray, starts: np.ndarray, power: Powers, width: int = WIDTH):
    """Sorted distinct shingle hashes (52 bits) of a chunk of at most 4096 documents.

    Returns (document of each hash, hash, number per document).
    """
    begin, end, first = word_spans(data, starts)
    words = span_hashes(data, begin, end, power)
    n_docs, n_words = len(starts) - 1, np.diff(first)
    window, _, bounds = window_hashes(words, first, width)
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    # short documents: one shingle of all words
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    whole = np.zeros(len(short), np.uint64)
    for k in range(width - 1):
        there = n_words[short] > k
        whole[there] += words[first[short[there]] + k] * np.uint64(0xD6E8FEB86659FD93 + 2 * k)
    whole = mix(whole + n_words[short].astype(np.uint64))
    key = (np.concatenate([doc, short]).astype(np.uint64) << np.uint64(52)) | (np.concatenate([window, whole]) >> np.uint64(12))
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    doc = (key >> np.uint64(52)).astype(np.int64)
    return doc, key & np.uint64((1 << 52) - 1), np.bincount(doc, minlength=n_docs)


def borrow_order(bins: int) -> np.ndarray:
    """For each bin, its own fixed random order of all bins."""
    return np.argsort(np.random.default_rng(20240607).random((bins, bins)), axis=1)


def densified(doc: np.ndarray, value: np.ndarray, n_docs: int, order: np.ndarray) -> np.ndarray:
    """One-permutation signature (n_docs x bins) with every empty bin filled; all-zero rows for empty sets."""
    bins = len(order)
    cell = doc * bins + ((value * np.uint64(bins)) >> np.uint64(52)).astype(np.int64)
    lead = np.append(True, cell[1:] != cell[:-1]) if len(cell) else np.empty(0, bool)  # sorted: the smallest is first
    out, full = np.zeros(n_docs * bins, np.uint64), np.zeros(n_docs * bins, bool)
    out[cell[lead]], full[cell[lead]] = value[lead], True
    some = np.repeat(full.reshape(n_docs, bins).any(axis=1), bins)
    gap, step = np.flatnonzero(~full & some), 0
    while len(gap):
        source = gap - gap % bins + order[gap % bins, step]
        found = full[source]
        out[gap[found]] = out[source[found]]
        gap, step = gap[~found], step + 1
    return out.reshape(n_docs, bins)


def band_keys(signature: np.ndarray, rows: int, bands: int) -> np.ndarray:
    weight = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    cells = signature.reshape(len(signature), bands, rows)
    return mix((cells * weight).sum(axis=2, dtype=np.uint64) + mix(np.arange(bands, dtype=np.uint64) + np.uint64(77)))


def _signatures(text: pa.Array) -> pa.Array:
    power, order = Powers(), borrow_order(ROWS * BANDS)
    n, h1, h2, bands = [], [], [], []
    for _, _, data, starts in text_chunks(text):
        doc, value, size = shingle_sets(LOWER_ASCII[data], starts, power)
        bounds = np.append(0, np.cumsum(size))
        n.append(size)
        h1.append(segment_sums(mix(value + np.uint64(3)), bounds))
        h2.append(segment_sums(mix(mix(value) ^ np.uint64(0x9E3779B97F4A7C15)), bounds))
        bands.append(band_keys(densified(doc, value, len(size), order), ROWS, BANDS))
    cat = lambda parts, kind: np.concatenate(parts).view(kind) if parts else np.empty(0, kind)
    flat = np.concatenate(bands).reshape(-1).view(np.int64) if bands else np.empty(0, np.int64)
    at = np.arange(0, len(flat) + 1, BANDS, dtype=np.int32)
    return pa.StructArray.from_arrays(
        [pa.array(cat(n, np.int64)), pa.array(cat(h1, np.int64)), pa.array(cat(h2, np.int64)),
         pa.ListArray.from_arrays(pa.array(at), pa.array(flat))], ["n", "h1", "h2", "bands"])


def _full_sets(text: pa.Array) -> pa.Array:
    power, values, sizes = Powers(), [np.empty(0, np.int64)], [np.zeros(1, np.int64)]
    for _, _, data, starts in text_chunks(text):
        _, value, size = shingle_sets(LOWER_ASCII[data], starts, power)
        values.append(value.astype(np.int64))
        sizes.append(size)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32)), pa.array(np.concatenate(values)))


def compatible(a: str, b: str, percent: int = PERCENT):
    """Sizes that leave room for the similarity: |smaller| / |larger| is an upper bound of it."""
    return (100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b)))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Of the pairs (a, b) of classes, those whose full shingle sets (rep, s) reach the similarity."""
    left = pairs.join(sets.select(F.col("rep").alias("b"), F.col("s").alias("sb")), "b")
    both = left.join(sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), "a")
    shared = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    union = F.size("sa") + F.size("sb") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b").distinct()


def block_links(rep: np.ndarray, comp: np.ndarray, size: np.ndarray, values: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Confirm all pairs of one block on full sets; return a spanning forest of the links between components."""
    m = len(rep)
    doc = np.repeat(np.arange(m), size)
    _, column, count = np.unique(values, return_inverse=True, return_counts=True)
    twice = count[column] > 1
    doc, column = doc[twice], column[twice]
    place = np.cumsum(count > 1) - 1
    column, width, common = place[column], 4096, np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [low, low + width])
        there = np.zeros((m, width), np.float32)
        there[doc[i:j], column[i:j] - low] = 1
        common += there @ there.T
    link = (100 * common >= percent * (size[:, None] + size[None, :] - common)) & (comp[:, None] != comp[None, :])
    root = np.arange(m)
    while True:
        least = np.minimum(root, np.where(link, root[None, :], m).min(axis=1))
        least = least[least]
        if (least == root).all():
            break
        root = least
    joined = np.flatnonzero(root != np.arange(m))
    return rep[root[joined]], rep[joined]


def block_meetings(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links (a, b) of members (key, rep, comp, cuts) that share a key, found block by block.

    A key is cut into ``cuts`` blocks of about ``block`` members and every two blocks meet in a group of
    their own, so a task holds two blocks at most and a group returns fewer links than members.
    """
    def confirm(group: pa.Table) -> pa.Table:
        rep, comp = (group.column(c).to_numpy() for c in ("rep", "comp"))
        s = group.column("s").combine_chunks()
        size = np.diff(s.offsets.to_numpy()).astype(np.int64)
        a, b = block_links(rep, comp, size, s.flatten().to_numpy(), percent)
        return pa.table({"a": a, "b": b})

    own = members.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("cuts")).cast("int"))
    meet = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    meet = meet.join(sets, "rep")
    meet = meet.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "comp", "s")
    return meet.groupBy("key", "i", "j").applyInArrow(confirm, "a bigint, b bigint")


def rare_meetings(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of large buckets, who may be alike by a rare shingle: pairs (a, b), and groups (key, rep, comp) of three or more.

    Groups of the same members count once; members of one component need not meet.
    """
    words = members.select("key", "rep", "comp").join(sets, "rep").select(
        "key", "rep", "comp", F.size("s").alias("n"), F.explode("s").alias("x"))
    words = materialize(words.withColumn("x", F.xxhash64("key", "x")), "open-shingles")
    ranked = join_heavy(words, words.groupBy("x").agg(F.count("*").alias("f")), "x")
    first = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100).cast("int") + 1
    rare = (ranked.groupBy("key", "rep", "comp", "n").agg(F.array_sort(F.collect_list(F.struct("f", "x"))).alias("w"))
            .select("rep", "comp", F.explode(F.slice("w", F.lit(1), first)).alias("w")).filter("w.f > 1").select("rep", "comp", "w.x"))
    rare = materialize(rare, "rare-shingles")
    total = lambda seed: F.sum(F.xxhash64("rep", F.lit(seed)).cast("decimal(38,0)"))
    groups = (rare.groupBy("x").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("c"), total(1).alias("h1"),
                                    total(2).alias("h2"), F.min("rep").alias("a"), F.max("rep").alias("b")).filter("lo <> hi"))
    groups = materialize(groups.groupBy("c", "h1", "h2", "a", "b").agg(F.min("x").alias("x")), "rare-groups")
    many = rare.join(groups.filter("c > 2").select("x"), "x", "left_semi")
    return groups.filter("c = 2").select("a", "b"), many.select(F.col("x").alias("key"), "rep", "comp")


def apart_links(members: DataFrame, sets: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Links between members (key, rep, comp) of one bucket that are in different components."""
    def cut(rows: DataFrame) -> DataFrame:
        return join_heavy(rows, rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("int").alias("cuts")), "key")

    sized = cut(members)
    links = block_meetings(sized.filter(F.col("cuts") <= LARGE), sets, percent, block)
    large = sized.filter(F.col("cuts") > LARGE)
    if not large.isEmpty():
        pairs, groups = rare_meetings(large, sets, percent)
        links = links.union(confirmed(pairs, sets, percent)).union(block_meetings(cut(groups), sets, percent, block))
    return links.distinct()


def connected(links: DataFrame) -> DataFrame:
    """(node, comp): components of an undirected edge table (a, b) by alternating large and small stars.

    Every step is an aggregation and a join by node; each round is written to the shared folder, and
    the driver reads only an edge count and checksum to see that nothing moves any more.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a <> b").distinct(), "links")

    def lowest(both_ways: DataFrame) -> DataFrame:
        return both_ways.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))

    mark = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(lowest(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        small = small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), "links")
        seen = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
        mark = seen


def row_keys() -> list:
    """Columns that tell rows apart, none of them null: doc_id is missing (last in order), doc_id or 0, hash of doc_id and text."""
    return [F.col("doc_id").isNull().alias("__none"), F.coalesce("doc_id", F.lit(0)).alias("__id"), F.xxhash64("doc_id", "text").alias("__hash")]


KEYS = ["__none", "__id", "__hash"]


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, row keys, n, and the row keys ``chosen`` of the row that stays for its group (null without shingles)."""
    docs = docs.select("doc_id", "text", *row_keys())
    signed = materialize(docs.select("doc_id", *KEYS, task_udf(_signatures, SIGNATURE)("text").alias("s"))
                         .select("doc_id", *KEYS, "s.*"), "signatures")
    klass = ["h1", "h2", "n"]
    classes = materialize(signed.filter("n > 0").groupBy(*klass)
                          .agg(F.min(F.struct(*KEYS)).alias("least"), F.first("bands").alias("bands"))
                          .withColumn("rep", F.monotonically_increasing_id()), "classes")
    rows = classes.select("rep", "n", F.explode("bands").alias("key"))
    # one centre per bucket, picked anew for each bucket
    centre = (rows.groupBy("key").agg(F.min(F.struct(F.xxhash64("rep", "key").alias("o"), "rep", "n")).alias("c"),
                                      F.count("*").alias("members")).filter("members > 1"))
    heavy = heavy_keys(rows, "key")  # at most 200 buckets
    shared = materialize(join_heavy(rows, centre.select("key", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n")), "key", heavy=heavy),
                         "buckets")
    # the full sets of classes that share a bucket, hashed anew from the text of one row
    wanted = classes.join(shared.select("rep").distinct(), "rep", "left_semi").select("rep", "least.*")
    sets = materialize(docs.select(*KEYS, "text").join(wanted, KEYS).dropDuplicates(KEYS)
                       .select("rep", task_udf(_full_sets, "array<bigint>")("text").alias("s")), "shingle-sets")
    stars = shared.filter((F.col("rep") != F.col("centre")) & compatible("n", "centre_n", percent))
    links = confirmed(stars.select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct(), sets, percent)
    links = materialize(links, "star-links")
    label = connected(links)

    # members of one bucket that are still apart
    member = shared.join(label, shared.rep == label.node, "left").select("key", "rep", F.coalesce("comp", "rep").alias("comp"))
    open_keys = member.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    member = materialize(join_heavy(member, open_keys, "key", heavy=heavy), "open-buckets")
    label = connected(links.union(apart_links(member, sets, percent)))

    # the least row of every component of two or more classes; other classes have their own
    ends = label.union(label.select("comp", "comp").distinct())
    ends = materialize(classes.select(*klass, "rep", "least").join(ends, F.col("rep") == ends.node, "left").drop("rep", "node"), "components")
    chosen = ends.filter("comp is not null").groupBy("comp").agg(F.min("least").alias("chosen"))
    named = join_heavy(ends.filter("comp is not null"), chosen, "comp").select(*klass, "chosen").unionByName(
        ends.filter("comp is null").select(*klass, F.col("least").alias("chosen")))
    # rows of a hot class stay where they are; rows without shingles need no class
    rows = signed.drop("bands")
    placed = join_heavy(rows.filter("n > 0"), named, "h1", on=klass).select("doc_id", *KEYS, "n", "chosen")
    return placed.unionByName(rows.filter("n = 0").select("doc_id", *KEYS, "n", F.lit(None).cast(named.schema["chosen"].dataType).alias("chosen")))


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (columns doc_id and text)."""
    component = F.when(F.col("chosen").isNull(), F.col("doc_id")).when(~F.col("chosen.__none"), F.col("chosen.__id"))
    return grouped(docs, percent).select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                                         F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents that stay: one row of each group, all columns as they were."""
    rows = grouped(docs, percent)
    # rows without words and without a doc_id cannot be told to be the same document: all of them stay
    bare = F.col("doc_id").isNull() & ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = rows.filter("chosen is null and doc_id is not null").select(*KEYS).union(rows.filter("chosen is not null").select("chosen.*")).distinct()
    named = docs.filter(~bare).withColumns(dict(zip(KEYS, row_keys()))).join(kept, KEYS, "left_semi").dropDuplicates(KEYS)
    return named.select(*docs.columns).unionByName(docs.filter(bare))
