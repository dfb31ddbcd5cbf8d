"""Merkle manifest of a dataset as a postorder append log.

Rows are leaves of one binary tree per group (here: per language), in a given order; two consecutive nodes become
``H(left + right)``, a last node without a partner ``H(node)``; the subroots, in the order of their groups, are the leaves of the
top tree.  ``H`` is the SHA-256 of its inputs' hex digests.

1. ``numbered`` gives every leaf its index in its group: a range partitioning, then a prefix sum over (group, partition), so a group
   that holds most rows is spread over many tasks.
2. ``build`` runs aligned builders: the nodes of one height are cut into runs of ``2 ** LEVELS``, and every builder turns
   its run into a subtree of its own, appending each node to the log when it is complete: children before
   parents.  The run's root is a leaf of the next pass; the number of passes is log(largest group) / ``LEVELS``.
3. A node's place in the log needs no index: after j leaves the log holds ``2 * j - popcount(j)`` nodes, and a subtree of
   height h has ``2 ** (h + 1) - 1`` of them, which gives the place of every complete node (``position``); nodes of the
   ragged right edge follow in the order of their heights.
4. ``paths`` extracts proofs by these places: the siblings of a builder's nodes are all in the builder's own segment of the log.
   Segments meet their nodes by (group, run), and the siblings above come down with the segment, one row per run.

Nothing is collected: groups are bounded by ``2 ** LEVELS`` nodes, the driver reads one number (the size of the largest group).

Defined results: a null group is a group of its own and comes first; null order values come first, rows that tie in all order
columns must have equal digests to make the result definite; a group of one leaf is its own subroot; an empty table has no rows
and no root; other columns of the leaves go along unless they have the names used here (``KEEP``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .arrays import task_udf

LEVELS = 12  # a builder takes 2 ** LEVELS nodes
KEEP = ("g", "k", "n", "digest", "path")
NODE = "g string, run bigint, height int, k bigint, n bigint, pos bigint, top boolean, digest binary"


def combine(*digests: bytes) -> bytes:
    """Parent of one or two nodes; digests are hashed as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def height_of(n: int) -> int:
    """Height of the root over n leaves."""
    return (n - 1).bit_length()


def position(height: int, k: int, n: int) -> int:
    """Place in the log of the k-th node of a height, in a tree of n leaves."""
    if (k + 1) << height <= n:  # complete: its last leaf j stands after 2 j - popcount(j) nodes, and the node h after it
        j = ((k + 1) << height) - 1
        return 2 * j - j.bit_count() + height
    return 2 * n - n.bit_count() + height - (n & -n).bit_length()  # ragged: after all complete nodes, lowest first


def append(digests: list[bytes], first: int, n: int, low: int, top: int) -> Iterator[tuple[int, int, bytes]]:
    """(height, k, digest) of a run of consecutive nodes of height ``low`` and of all above them up to ``top``, in completion order."""
    waiting: dict[int, bytes] = {}
    for k, d in enumerate(digests, first):
        h = low
        yield h, k, d
        while h < top and k % 2:
            k, d, h = k // 2, combine(waiting.pop(h), d), h + 1
            yield h, k, d
        if h < top:
            waiting[h] = d
    # the right edge: a node without a partner goes up alone
    k, d = first + len(digests) - 1, None
    for h in range(low, top):
        if d is None and h in waiting:
            d = combine(waiting.pop(h))
            yield h + 1, k // 2, d
        elif d is not None:
            d = combine(waiting.pop(h), d) if k % 2 else combine(d)
            yield h + 1, k // 2, d
        k //= 2


def group_key(column: str) -> Column:
    """A text that is never null and sorts as the column does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``k``, the index of the row in its group ``g`` by ``order``, and ``n``, the size of the group."""
    placed = materialize(rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
                         .withColumn("__at", F.monotonically_increasing_id()), "merkle-order")
    part = F.call_function("shiftright", F.col("__at"), F.lit(33))
    counts = placed.groupBy("g", part.alias("__part")).agg(F.min("__at").alias("__low"), F.count("*").alias("__n"))
    own = Window.partitionBy("g")
    before = F.coalesce(F.sum("__n").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("g", "__part", (before - F.col("__low")).alias("__shift"), F.sum("__n").over(own).alias("n"))
    return (placed.withColumn("__part", part).join(offsets, ["g", "__part"])
            .withColumn("k", (F.col("__at") + F.col("__shift")).cast("bigint")).drop("__at", "__part", "__shift"))


def _builder(low: int, levels: int):
    """Task function: one run of nodes of height ``low`` to its part of the log."""
    def run(nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("k")
        g, n, ks = nodes.column("g")[0].as_py(), nodes.column("n")[0].as_py(), nodes.column("k").to_pylist()
        top = height_of(n)
        out = list(append(nodes.column("digest").to_pylist(), ks[0], n, low, min(low + levels, top)))
        return pa.table({
            "g": pa.array([g] * len(out), pa.string()), "run": pa.array([ks[0] >> levels] * len(out), pa.int64()),
            "height": pa.array([h for h, _, _ in out], pa.int32()), "k": pa.array([k for _, k, _ in out], pa.int64()),
            "n": pa.array([n] * len(out), pa.int64()), "pos": pa.array([position(h, k, n) for h, k, _ in out], pa.int64()),
            "top": pa.array([h == top for h, _, _ in out]), "digest": pa.array([d for _, _, d in out], pa.binary())})

    return run


def _prover(low: int, levels: int):
    """Task function: nodes of height ``low`` and the segment of their run to nodes with their paths."""
    def run(nodes: pa.Table, segment: pa.Table) -> pa.Table:
        place = dict(zip(segment.column("pos").to_pylist(), segment.column("digest").to_pylist()))
        tail = next((x for x in segment.column("path").to_pylist() if x is not None), [])
        out = []
        for k, n in zip(nodes.column("k").to_pylist(), nodes.column("n").to_pylist()):
            path = []
            for h in range(low, min(low + levels, height_of(n))):
                if (k ^ 1) << h < n:  # the sibling exists
                    path.append(place[position(h, k ^ 1, n)])
                k >>= 1
            out.append(path + tail)
        return nodes.append_column("path", pa.array(out, pa.list_(pa.binary())))

    return run


def build(leaves: DataFrame, levels: int = LEVELS) -> list[DataFrame]:
    """The log of the trees over ``leaves`` (g, k, n, digest): one table per pass, each segment in completion order.

    The table of a pass holds the nodes it took (the leaves, or roots of the pass before) and those it made.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 1
    nodes, passes = leaves.select("g", "k", "n", "digest"), []
    for p in range(max(1, -(-height_of(largest) // levels))):
        low = p * levels
        made = nodes.groupBy("g", F.call_function("shiftright", F.col("k"), F.lit(levels)).alias("run")).applyInArrow(_builder(low, levels), NODE)
        passes.append(materialize(made, "merkle-log"))
        nodes = passes[-1].filter((F.col("height") == low + levels) & ~F.col("top")).select("g", "k", "n", "digest")
    return passes


def log_of(passes: list[DataFrame], levels: int = LEVELS) -> DataFrame:
    """The log (g, pos, height, k, digest): every node once, at its place in completion order."""
    parts = [t if p == 0 else t.filter(F.col("height") > p * levels) for p, t in enumerate(passes)]
    out = parts[0]
    for t in parts[1:]:
        out = out.unionByName(t)
    return out.select("g", "pos", "height", "k", "digest")


def subroots(passes: list[DataFrame]) -> DataFrame:
    """(g, n, digest): root of every group."""
    out = passes[0]
    for t in passes[1:]:
        out = out.unionByName(t)
    return out.filter("top").groupBy("g").agg(F.max("n").alias("n"), F.max("digest").alias("digest"))


def paths(leaves: DataFrame, passes: list[DataFrame], above: DataFrame | None = None, levels: int = LEVELS) -> DataFrame:
    """``leaves`` (g, k, n and any other columns) with ``path``: the digests of the siblings, from the leaf to the root.

    ``above`` (g, path) continues the path beyond the root of the group.  Levels without a sibling give no entry.
    """
    ahead = None  # (g, run, path): siblings above the runs of the pass at hand
    for p in reversed(range(len(passes))):
        low, log = p * levels, passes[p]
        runs = log.select("g", "run", "pos", "digest", F.lit(None).cast("array<binary>").alias("path"))
        if above is not None:  # the run that holds the root of its group continues there
            ends = log.filter("top").select("g", "run").distinct().join(above.select("g", "path"), "g")
            ahead = ends if ahead is None else ahead.unionByName(ends)
        if ahead is not None:
            runs = runs.unionByName(ahead.select("g", "run", F.lit(-1).cast("bigint").alias("pos"),
                                                 F.lit(None).cast("binary").alias("digest"), "path"))
        # named anew: the nodes of an upper pass come from the same table as the segments they meet
        nodes = leaves if p == 0 else log.filter(F.col("height") == low).select(*[F.col(c).alias(c) for c in ("g", "k", "n")])
        kept = [c for c in nodes.columns if c != "path"]
        schema = T.StructType([*nodes.select(*kept).schema.fields, T.StructField("path", T.ArrayType(T.BinaryType()))])
        of = F.call_function("shiftright", F.col("k"), F.lit(levels)).alias("run")
        met = nodes.select(*kept).groupBy("g", of).cogroup(runs.groupBy("g", "run")).applyInArrow(_prover(low, levels), schema)
        if p == 0:
            return met
        # a node of this pass is the root of the run with its number in the pass below
        ahead = materialize(met.select("g", F.col("k").alias("run"), "path"), "merkle-paths")
    raise AssertionError("a log has at least one pass")


def folded(leaf: Column, steps: list[tuple[Column, Column]], path: Column) -> Column:
    """Root that follows from a leaf digest, its (k, n) in each tree on the way and the siblings."""
    def run(leaf: pa.Array, path: pa.Array, *steps: pa.Array) -> pa.Array:
        out = []
        where = [s.to_pylist() for s in steps]
        for r, (d, siblings) in enumerate(zip(leaf.to_pylist(), path.to_pylist())):
            sibling = iter(siblings)
            for k, n in zip((w[r] for w in where[::2]), (w[r] for w in where[1::2])):
                for h in range(height_of(n)):
                    if k % 2:
                        d = combine(next(sibling), d)
                    else:
                        d = combine(d, next(sibling)) if (k + 1) << h < n else combine(d)
                    k //= 2
            out.append(d)
        return pa.array(out, pa.binary())

    return task_udf(run, "binary")(leaf, path, *[c for s in steps for c in s])


def field(value: Column) -> Column:
    """A value as part of a leaf: its UTF-8 byte count, a colon and the text; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the fields of a row."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, path, folded_root of every row of ``docs``, all digests binary.

    The tree of a language is ordered by doc_id.  ``folded_root`` starts from the leaf as it is with 1 added to ``n_chars`` where
    ``tampered`` holds, and takes the siblings of the original.
    """
    of = lambda n: leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), n, F.col("text"))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    leaves = docs.select("doc_id", group_key("lang").alias("g"), of(F.col("n_chars")).alias("digest"),
                         F.when(tampered & F.col("n_chars").isNotNull(), of(more)).alias("changed"))
    leaves = materialize(numbered(leaves, ["doc_id", "digest"]), "merkle-leaves")
    trees = build(leaves)
    groups = subroots(trees).select(F.col("g").alias("name"), "digest").withColumn("g", F.lit("top"))
    groups = materialize(numbered(groups, ["name"]), "merkle-groups")
    top = build(groups)
    root = subroots(top).select(F.col("digest").alias("root"))  # one row at most
    above = materialize(paths(groups, top).join(F.broadcast(root)).select(
        F.col("name").alias("g"), F.col("digest").alias("subroot"), "root", "path",
        F.col("k").alias("group_k"), F.col("n").alias("group_n")), "merkle-subroots")
    proven = paths(leaves, trees, above)
    out = proven.join(above.drop("path"), "g")
    folds = folded(F.coalesce("changed", "digest"), [(F.col("k"), F.col("n")), (F.col("group_k"), F.col("group_n"))], F.col("path"))
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path", folds.alias("folded_root"))
