"""What the ingest query and the tables it keeps leave on disk."""

from __future__ import annotations

import os

import pytest

from skirmish.operators import normalize
from skirmish.plans import oracle, queries
from skirmish.session import scratch_path
from skirmish.streaming import versions
from skirmish.streaming.graph_tables import GraphTables
from skirmish.streaming.versions import BucketStore, Keyed
from tests.conftest import SF_SMALL
from tests.util import duck, match_model, rows, same_rows


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def size(folder: str) -> int:
    return sum(os.path.getsize(f"{d}/{n}") for d, _, names in os.walk(folder) for n in names if not n.startswith((".", "_")))


def test_ingest_in_several_batches_leaves_little_on_disk(spark, monkeypatch):
    asked = []
    scratch = queries.scratch_path
    monkeypatch.setattr(queries, "scratch_path", lambda *a: asked.append(scratch(*a)) or asked[-1])
    monkeypatch.setattr(queries, "GZIP_PER_CORE", 1, raising=False)  # every file is a micro-batch
    got = queries.stream_ingest_graph(spark, SF_SMALL).toPandas()
    expected = duck(SF_SMALL).sql(oracle.oracle_sql()["stream_ingest_graph"]).df()
    assert len(expected) > 0 and same_rows(got, expected)
    root = local(asked[0])
    for folder in ("landed", "topic"):  # compressed, and whole
        text = spark.read.option("recursiveFileLookup", "true").text(f"{asked[0]}/{folder}").selectExpr("sum(length(value))").first()[0]
        assert 4 * size(f"{root}/{folder}") < text
    left = [n for n in os.listdir(f"{root}/graph/_log") if n.endswith(".json")]
    assert 1 <= len(left) <= 2


def test_a_merge_removes_its_scratch_folder(spark, monkeypatch):
    asked = []
    scratch = scratch_path
    monkeypatch.setattr("skirmish.session.scratch_path", lambda *a: asked.append(scratch(*a)) or asked[-1])
    monkeypatch.setattr(versions, "scratch_path", lambda *a: asked.append(scratch(*a)) or asked[-1], raising=False)
    store = BucketStore(spark, scratch(spark, "t-merge"), {"t": Keyed("k BIGINT, n BIGINT", ("k",), {"n": versions.F.sum})}, 4)
    for batch in range(3):
        store.merge({"t": spark.createDataFrame([(i, 1) for i in range(batch * 5)], "k BIGINT, n BIGINT")}, batch)
    assert rows(store.read("t")) == [(i, 2 if i < 5 else 1) for i in range(10)]
    assert len(asked) == 3 and not [p for p in asked if os.path.exists(local(p))]


def test_graph_tables_keep_the_versions_a_replay_needs(spark):
    edges = normalize.match_edges(match_model(
        spark, [(m, None, 10, 100, "Win", 200, "Fail", 1) for m in (1, 2, 3, 4)],
        [(m, p, k, 1, team) for m in (1, 2, 3, 4) for p, (k, team) in enumerate([(1, 100), (m + 1, 200)])])).cache()
    live = GraphTables(spark, scratch_path(spark, "t-keep"), buckets=2, keep=2)
    for batch in range(4):
        live.add(edges.filter(edges.match_id == batch + 1), batch)
    want = [rows(live.read(t)) for t in ("vertices", "counts", "edges")]
    assert len(live.log.versions()) == 2
    live.add(edges.filter("match_id = 4"), 3)  # a replay of the last batch
    assert [rows(live.read(t)) for t in ("vertices", "counts", "edges")] == want and len(want[2]) == 4
    with pytest.raises(ValueError, match="replay"):
        GraphTables(spark, "x", keep=1)
