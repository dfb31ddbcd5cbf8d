"""Match lists and matches as two streams: the entries' status over several micro-batches, without Python in the stream."""

from __future__ import annotations

from skirmish.session import scratch_path
from skirmish.streaming import jobs
from tests.util import rows

NOW = {"availableNow": True}
LISTED = "account_id STRING, game_id BIGINT"
#: (list entries, matches) landed before each run
ROUNDS = [
    ([("a", 1), ("b", 1), ("a", 2), ("a", 2), (None, 1), ("a", None)], [(1,), (9,), (None,)]),
    ([("c", 1), ("a", 1), ("a", 9), ("b", 3)], [(1,), (2,)]),
    ([("d", 3), ("a", 2)], [(4,)]),
]
EXPECTED = [
    [("a", 1, "matched"), ("a", 2, "pending"), ("b", 1, "matched")],
    [("a", 1, "matched"), ("a", 2, "matched"), ("a", 9, "matched"), ("b", 1, "matched"), ("b", 3, "pending"), ("c", 1, "matched")],
    [("a", 1, "matched"), ("a", 2, "matched"), ("a", 9, "matched"), ("b", 1, "matched"), ("b", 3, "pending"), ("c", 1, "matched"),
     ("d", 3, "pending")],
]


def run_all(spark, rounds):
    """Plan of the last query, and the store's rows after every round."""
    root = scratch_path(spark, "t-arrivals")
    store = jobs.arrivals_store(spark, f"{root}/store", buckets=4)
    found = []
    for entries, games in rounds:
        spark.createDataFrame(entries, LISTED).write.mode("append").json(f"{root}/lists")
        spark.createDataFrame(games, "game_id BIGINT").write.mode("append").json(f"{root}/games")
        listed, landed = (spark.readStream.schema(s).json(f"{root}/{n}") for s, n in ((LISTED, "lists"), ("game_id BIGINT", "games")))
        query = jobs.start_list_arrivals(listed, landed, store, f"{root}/checkpoint", NOW)
        jobs.run_available(query)
        found.append(rows(store.read("arrivals")))
    return query._jsq.explainInternal(False), found


def test_entries_wait_for_their_match(spark):
    assert run_all(spark, ROUNDS)[1] == EXPECTED


def test_no_game_passes_through_python(spark):
    games = 300
    plan, found = run_all(spark, [([(f"{i % 7}", i) for i in range(games)], [(i,) for i in range(0, games, 3)])])
    assert found[0] == sorted((f"{i % 7}", i, "pending" if i % 3 else "matched") for i in range(games))
    assert "StateStoreSave" in plan and "Python" not in plan and "TransformWithState" not in plan
