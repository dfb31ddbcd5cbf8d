"""Merkle manifest: places in the log, trees, proofs and tampering against a plain tree."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from skirmish.llm import merkle, queries
from skirmish.session import scratch_path
from tests.conftest import SF_SMALL
from tests.llm.util import awkward, empty


def digest(x):
    return hashlib.sha256(x).digest()


def plain_tree(leaves):
    """Levels of the tree, leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([merkle.combine(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def plain_path(levels, k):
    out = []
    for level in levels[:-1]:
        if k ^ 1 < len(level):
            out.append(level[k ^ 1])
        k //= 2
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 16, 17, 31, 33, 64, 100])
def test_closed_form_places_follow_the_order_of_completion(n):
    leaves = [digest(b"%d" % i) for i in range(n)]
    levels = plain_tree(leaves)
    log = list(merkle.append(leaves, 0, n, 0, merkle.height_of(n)))
    assert [merkle.position(h, k, n) for h, k, _ in log] == list(range(len(log)))
    assert {(h, k): d for h, k, d in log} == {(h, k): d for h, level in enumerate(levels) for k, d in enumerate(level)}
    place = {(h, k): p for p, (h, k, _) in enumerate(log)}
    for h, k, _ in log:  # children stand before their parent; a complete subtree takes 2 ** (h + 1) - 1 places
        if h:
            assert place[h - 1, 2 * k] < place[h, k]
        if h < merkle.height_of(n) and k % 2 == 0 and (k + 2) << h <= n:
            assert place[h, k + 1] == place[h, k] + 2 ** (h + 1) - 1


def leaves_of(spark, sizes):
    rows = [(g, i, digest(f"{g}{i}".encode())) for g, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "g string, at int, digest binary").repartition(7)


@pytest.mark.parametrize("levels", [1, 2, 3, 12])
def test_builders_of_any_size_write_the_same_log(spark, levels):
    sizes = {"a": 1, "b": 2, "c": 37, "d": 64, "e": 5}
    rows = merkle.materialize(merkle.numbered(leaves_of(spark, sizes), ["at"]), "test-leaves")
    passes = merkle.build(rows, levels)
    got = {}
    for r in merkle.log_of(passes, levels).collect():
        assert got.setdefault((r.g, r.pos), (r.height, r.k, bytes(r.digest))) == (r.height, r.k, bytes(r.digest))
    tree = {g: plain_tree([digest(f"{g}{i}".encode()) for i in range(n)]) for g, n in sizes.items()}
    want = {(g, merkle.position(h, k, sizes[g])): (h, k, d) for g, t in tree.items() for h, level in enumerate(t) for k, d in enumerate(level)}
    assert got == want
    assert {r.g: bytes(r.digest) for r in merkle.subroots(passes).collect()} == {g: t[-1][0] for g, t in tree.items()}
    above = spark.createDataFrame([(g, [digest(g.encode())]) for g in sizes], "g string, path array<binary>")
    for r in merkle.paths(rows, passes, above, levels).collect():
        assert r.k == r.at and r.n == sizes[r.g]
        assert [bytes(x) for x in r.path] == plain_path(tree[r.g], r.k) + [digest(r.g.encode())]


def field(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def plain_manifest(rows):
    """Set of (doc_id, leaf, subroot, root, proof, folded, verified) over (doc_id, source, lang, n_chars, text)."""
    def leaf(doc_id, source, lang, n_chars, text):
        return digest("".join(map(field, (doc_id, source, lang, n_chars, text))).encode())

    groups = {}
    for r in rows:
        groups.setdefault((r[2] is not None, (r[2] or "").encode()), []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    groups = [sorted(groups[g], key=lambda x: x[:3]) for g in sorted(groups)]
    trees = [plain_tree([x[2] for x in g]) for g in groups]
    top = plain_tree([t[-1][0] for t in trees])
    out = []
    for j, (g, tree) in enumerate(zip(groups, trees)):
        for k, (_, _, d, r) in enumerate(g):
            proof, fold = [], d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                fold = leaf(*r[:3], r[3] + 1, r[4])
            for levels, at in ((tree, k), (top, j)):
                for level in levels[:-1]:
                    other = [level[at ^ 1]] if at ^ 1 < len(level) else []
                    proof += other
                    fold = merkle.combine(*(other + [fold] if at % 2 else [fold] + other))
                    at //= 2
            out.append((r[0], d.hex(), tree[-1][0].hex(), top[-1][0].hex(), hashlib.sha256("".join(p.hex() for p in proof).encode()).hexdigest(),
                        fold.hex(), fold == top[-1][0]))
    return sorted(out, key=str)


def query_over(spark, docs):
    path = scratch_path(spark, "merkle-input")
    docs.write.parquet(f"{path}/documents.parquet")
    return sorted(map(tuple, queries.op12_merkle_manifest(spark, path).collect()), key=str)


def test_query_equals_plain_manifest(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = sorted(map(tuple, queries.op12_merkle_manifest(spark, SF_SMALL).collect()), key=str)
    assert got == plain_manifest(rows)
    assert {r[-1] for r in got} == {True, False}


def test_awkward_documents(spark):
    docs = awkward(spark).withColumn("n_chars", F.when(F.col("doc_id") > 1, F.lit((1 << 63) - 1)))
    for k in range(5):  # a doc_id whose tampering reaches the largest BIGINT, repeated rows, null languages
        docs = docs.union(docs.limit(1).withColumn("doc_id", F.lit(100 + k)))
    docs = docs.union(docs)
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert query_over(spark, docs) == plain_manifest(rows)


def test_empty_and_single(spark):
    assert query_over(spark, empty(spark)) == []
    one = awkward(spark).limit(1)
    (row,) = query_over(spark, one)
    assert row[1] == row[2] == row[3] == row[5] and row[4] == hashlib.sha256(b"").hexdigest() and row[6]


def test_other_columns_go_along(spark):
    rows = leaves_of(spark, {"x": 5}).withColumn("path", F.lit("mine")).withColumn("extra", F.col("at") * 2)
    rows = merkle.materialize(merkle.numbered(rows, ["at"]), "test-leaves")
    out = merkle.paths(rows, merkle.build(rows))
    assert dict(out.dtypes)["path"] == "array<binary>" and {r.extra for r in out.collect()} == {0, 2, 4, 6, 8}
