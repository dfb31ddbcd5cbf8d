"""Bucketed match tables: same rows as the flat model, loads that repeat, new sessions."""

from __future__ import annotations

from skirmish.operators import normalize
from skirmish.session import scratch_path
from skirmish.sources import match_store
from tests.util import match_model

MATCHES = [(1, None, 10, 100, "Win", 200, "Fail", 1), (2, None, 20, 100, "Fail", 200, "Win", 2), (3, None, 30, 100, "Fail", 200, "Fail", 99),
           (4, None, 40, 200, "Win", 100, "Fail", 3)]
PARTICIPANTS = [(1, 0, 1, 1, 100), (1, 1, 5, 2, 200), (1, 2, 1, 3, 200), (1, 3, None, 4, 100),  # the tracked player twice, an unknown one
                (2, 0, 7, 77, 100), (2, 1, 8, 1, 200),  # the tracked player is absent, an unknown champion
                (3, 0, 1, 1, 100)]  # match 4 has no participants
BANS = [(1, 2, 5), (1, 1, -1), (2, 1, 99)]


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_store_equals_the_flat_model(spark):
    t = match_model(spark, MATCHES, PARTICIPANTS, BANS)
    store = match_store.open_store(spark, scratch_path(spark, "t-store"), 3)
    assert store.edges().count() == 0 and store.events().count() == 0  # an empty store
    store.add(t)
    assert sorted_rows(store.edges()) == sorted_rows(normalize.match_edges(t))
    assert sorted_rows(store.events()) == sorted_rows(normalize.event_documents(t))


def test_loads_that_repeat_and_grow(spark):
    first = match_model(spark, MATCHES[:2], [p for p in PARTICIPANTS if p[0] < 3], BANS)
    whole = match_model(spark, MATCHES, PARTICIPANTS, BANS)
    root = scratch_path(spark, "t-store")
    store = match_store.open_store(spark, root, 4)
    for t in (first, first, whole, whole):
        store.add(t)
        assert sorted_rows(store.edges()) == sorted_rows(normalize.match_edges(t))
    again = match_store.open_store(spark, root, 4)  # as a later session finds it
    assert sorted_rows(again.events()) == sorted_rows(normalize.event_documents(whole))


def test_a_load_that_stopped_half_way_is_completed(spark):
    t = match_model(spark, MATCHES, PARTICIPANTS, BANS)
    store = match_store.open_store(spark, scratch_path(spark, "t-store"), 2)
    store.add(match_model(spark, MATCHES, PARTICIPANTS, BANS, match_list=[]))  # participants and bans, no tracked rows yet
    assert store.edges().count() == 0
    store.add(t)
    assert sorted_rows(store.edges()) == sorted_rows(normalize.match_edges(t))
