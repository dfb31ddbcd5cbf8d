"""The shared folder under the settings a cluster may have."""

from __future__ import annotations

import pytest

from skirmish import session
from skirmish.plans import queries
from tests.conftest import SF_SMALL


@pytest.fixture
def cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://driver:7077")
    return spark


def test_a_folder_without_scheme_lies_in_the_default_file_system(cluster, tmp_path):
    before = cluster.conf.get("spark.checkpoint.dir", None)
    try:
        cluster.conf.set("spark.checkpoint.dir", f"{tmp_path}/kept")
    except Exception:  # the session may not let it change: then it is the folder of its own settings
        pass
    root = cluster.conf.get("spark.checkpoint.dir", None) or cluster.sparkContext.getCheckpointDir()
    try:
        assert session.shared_dir(cluster) == "file:" + root.removeprefix("file:").rstrip("/")
        got = queries.champion_dimension(cluster, SF_SMALL)
        assert got.count() > 0 and all("file:/" in f for f in got.inputFiles())
    finally:
        if before and cluster.conf.get("spark.checkpoint.dir") != before:
            cluster.conf.set("spark.checkpoint.dir", before)


def test_a_cluster_without_a_checkpoint_folder_uses_its_warehouse(cluster, monkeypatch):
    real = type(cluster.conf).get
    monkeypatch.setattr(type(cluster.conf), "get", lambda c, key, *d: None if key == "spark.checkpoint.dir" else real(c, key, *d))
    monkeypatch.setattr(type(cluster.sparkContext), "getCheckpointDir", lambda _: None)
    named = []
    monkeypatch.setattr(type(cluster.sparkContext), "setCheckpointDir", lambda _, d: named.append(d))
    root = session.shared_dir(cluster)
    assert root == real(cluster.conf, "spark.sql.warehouse.dir").rstrip("/") and named == [root]


def test_users_of_one_shared_folder_have_no_folder_in_common(spark):
    """A common folder belongs to the user whose job came first; every other user's writes failed."""
    paths = [session.scratch_path(spark, "champions") for _ in range(2)]
    assert {p.rpartition("/")[0] for p in paths} == {session.shared_dir(spark)} and len(set(paths)) == 2
