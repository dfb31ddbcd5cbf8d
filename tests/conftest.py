from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from skirmish.session import build_session, shared_dir

    s = build_session("local[*]", app_name="skirmish-tests", shuffle_partitions=8)
    shared_dir(s)  # checkpoint dir: the configured one, or a local one in tests
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_tables(spark):
    from skirmish.sources import tables
    return tables.load(spark, SF_SMALL)
