"""Queries that write first, on a cluster whose driver and executors share the warehouse, but no temp folder and no checkpoint folder."""

from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

from skirmish import session
from skirmish.plans import oracle, queries
from tests.conftest import ROOT, SF_SMALL
from tests.util import duck, same_rows

WRITERS = [
    "champion_dimension",
    "edges_csv_roundtrip",
    "edges_folded",
    "graph_degrees",
    "graph_export_merged",
    "graph_export_nodes",
    "graph_export_rels",
    "graph_job_files",
    "match_list_arrivals",
    "match_store_edges",
    "match_list_documents",
    "match_store_events",
    "pattern_match_hop",
    "pattern_match_hop_heavy",
    "poll_store",
    "raw_document_edges",
    "roster_documents",
    "raw_document_quarantine",
    "running_bans_state",
    "stats_panes_stream",
]
ON_EXECUTORS = ["champion_dimension", "edges_folded"]  # lost all rows and failed when the folder was a temp folder of each process

TABLES = {
    "customer": "SELECT i AS c_custkey, 'Customer#' || i AS c_name FROM range(1, 26) t(i)",
    "part": "SELECT i AS p_partkey, 'Brand#' || i % 7 AS p_brand, (i % 12)::INTEGER AS p_size FROM range(1, 26) t(i)",
    "orders": "SELECT i AS o_orderkey, 1 + i * 7 % 25 AS o_custkey, CASE WHEN i % 2 = 0 THEN 'O' ELSE 'F' END AS o_orderstatus, "
              "i * 100.5::DOUBLE AS o_totalprice, TIMESTAMP '2024-01-01' + to_hours(i::INTEGER) AS o_orderdate FROM range(1, 41) t(i)",
    "lineitem": "SELECT i AS l_orderkey, 1 + (i * 3 + j * 5) % 25 AS l_partkey, 1 + (i + j) % 9 AS l_suppkey, j::INTEGER AS l_linenumber, "
                "(1 + (i + j) % 4)::DOUBLE AS l_quantity FROM range(1, 41) t(i), range(1, 5) u(j)",
    **{t: "SELECT 0 AS none" for t in ("region", "nation", "supplier", "events")},
}

JOB = """
import os, pathlib, sys, threading, time
home, tables, out = sys.argv[1:4]
def temp_folders():
    while True:
        for own in pathlib.Path(home, "work").glob("*/*/"):
            os.makedirs(own / ".tmp", exist_ok=True)
        time.sleep(0.1)
threading.Thread(target=temp_folders, daemon=True).start()
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[2,2,1024]").config(map={
    "spark.executor.memory": "1g", "spark.ui.enabled": "false", "spark.driver.host": "127.0.0.1", "spark.sql.session.timeZone": "UTC",
    "spark.sql.shuffle.partitions": "2", "spark.sql.warehouse.dir": out + "/warehouse"}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__ as entry
found = entry.queries()
for name in sys.argv[4:]:
    try:
        found[name](spark, tables).coalesce(1).write.parquet(f"{out}/{name}")
    except Exception as e:
        pathlib.Path(f"{out}/{name}.failed").write_text(f"{type(e).__name__}: {str(e)[:300]}")
spark.stop()
"""


class Reached(Exception):
    """The query asked for its first folder."""


@pytest.mark.parametrize("name", WRITERS)
def test_a_query_writes_below_the_warehouse(spark, monkeypatch, name):
    real, context = type(spark.conf).get, spark.sparkContext
    monkeypatch.setattr(context, "master", "local-cluster[2,2,1024]")
    monkeypatch.setattr(type(spark.conf), "get", lambda c, key, *d: None if key == "spark.checkpoint.dir" else real(c, key, *d))
    monkeypatch.setattr(type(context), "getCheckpointDir", lambda _: None)
    monkeypatch.setattr(type(context), "setCheckpointDir", lambda *_: None)
    scratch, asked = session.scratch_path, []

    def first(*args):
        asked.append(scratch(*args))
        raise Reached

    monkeypatch.setattr(session, "scratch_path", first)
    monkeypatch.setattr(queries, "scratch_path", first)
    with pytest.raises(Reached):
        queries.REGISTRY[name](spark, SF_SMALL)
    assert asked[0].startswith(real(spark.conf, "spark.sql.warehouse.dir").rstrip("/") + "/")


@pytest.fixture(scope="module")
def cluster_run(tmp_path_factory):
    """(tables, results): each executor works in a folder of its own and so has its own temp folder, as on machines of its own."""
    import pyspark

    root = tmp_path_factory.mktemp("cluster")
    home, tables, out, conf = (root / n for n in ("home", "tables", "out", "conf"))
    for folder in (home / "work", tables, out, conf, root / ".tmp"):
        folder.mkdir(parents=True)
    for name in os.listdir(pyspark.__path__[0]):
        if name != "work":
            (home / name).symlink_to(f"{pyspark.__path__[0]}/{name}")
    for name, sql in TABLES.items():
        duckdb.execute(f"COPY ({sql}) TO '{tables}/{name}.parquet' (FORMAT parquet)")
    env = os.environ | {"SPARK_HOME": str(home), "SPARK_CONF_DIR": str(conf), "SPARK_SCALA_VERSION": "2.13", "PYTHONPATH": ROOT,
                        "PYSPARK_PYTHON": sys.executable, "SPARK_LOCAL_DIRS": str(root / "local"), "TMPDIR": "/proc/self/cwd/.tmp"}
    run = subprocess.run([sys.executable, "-c", JOB, home, tables, out, *ON_EXECUTORS], cwd=root, env=env, capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-2000:]
    return tables, out


@pytest.mark.parametrize("name", ON_EXECUTORS)
def test_executors_see_what_the_query_wrote(cluster_run, name):
    tables, out = cluster_run
    failed = out / f"{name}.failed"
    assert not failed.exists(), failed.read_text()
    got = duckdb.sql(f"SELECT * FROM read_parquet('{out}/{name}/*.parquet')").df()
    expected = duck(str(tables)).sql(oracle.oracle_sql()[name]).df()
    assert len(expected) > 0 and same_rows(got, expected)
