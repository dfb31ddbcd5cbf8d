"""Every registered query against its DuckDB oracle on the driver tables."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry
from skirmish.plans import oracle, queries
from tests.conftest import SF_SMALL
from tests.util import duck, normalise

ORACLE = oracle.oracle_sql()
QUERIES = queries.REGISTRY


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    exp = con.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert normalise(got).equals(normalise(exp))


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "name", "tracking", "in_degree", "out_degree"]
    assert df.count() > 0


def test_python_udf_runs_without_package_on_worker_path(tmp_path):
    """The driver may import the package from anywhere; workers must not need it installed."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "import __spark_entry__ as e\n"
        f"print(e.queries()['player_id_hash'](s, {SF_SMALL!r}).count())\n")
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().splitlines()[-1] == "150"
