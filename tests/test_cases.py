"""Hand-written edge cases of the reference semantics (small inputs)."""

from __future__ import annotations

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from skirmish import schemas
from skirmish.functions.hashing import murmur3_string_hash
from skirmish.operators import bans, graph, marts, normalize
from skirmish.session import scratch_path
from skirmish.sources import documents, graph_files
from tests.util import match_model, rows

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def one_match(spark, win0="Win", win1="Fail", parts=None, tracked=1, bans_=()):
    parts = parts if parts is not None else [
        (1, 0, tracked, 1, 100), (1, 1, 2, 2, 100), (1, 2, 3, 3, 200), (1, 3, 4, 4, 200)]
    return match_model(spark, [(1, T0, 1800, 100, win0, 200, win1, tracked)], parts, bans_)


def test_winner_sides_and_remake(spark):
    t = match_model(spark, [
        (1, T0, 10, 100, "Win", 200, "Fail", 1),
        (2, T0, 10, 100, "Fail", 200, "Win", 1),
        (3, T0, 10, 100, "Fail", 200, "Fail", 1),   # remake: team index 1 declared winner
        (4, T0, 10, 200, "Win", 100, "Fail", 1),    # teams listed in the other order
    ], [])
    got = dict((r.match_id, r.winner) for r in normalize.match_events(t).collect())
    assert got == {1: "Blue", 2: "Red", 3: "Red", 4: "Red"}


def test_edges_outcome_and_competition(spark):
    t = one_match(spark)
    e = {r.participant_id: (r.outcome, r.competition, r.my_champion, r.his_champion)
         for r in normalize.match_edges(t).collect()}
    # blue (100) won; outcome describes the *other* participant
    assert e == {1: ("Win", "Together", "Champ1", "Champ2"),
                 2: ("Fail", "Against", "Champ1", "Champ3"),
                 3: ("Fail", "Against", "Champ1", "Champ4")}


def test_tracked_name_absent_everyone_against(spark):
    parts = [(1, 1, 2, 2, 100), (1, 2, 3, 3, 200)]
    e = normalize.match_edges(one_match(spark, parts=parts)).collect()
    assert {(r.participant_id, r.competition, r.my_champion) for r in e} == {
        (1, "Against", "None"), (2, "Against", "None")}


def test_unknown_identity_and_champion(spark):
    parts = [(1, 0, 1, 1, 100), (1, 1, 999, 77, 200)]
    (r,) = normalize.match_edges(one_match(spark, parts=parts)).collect()
    assert (r.his_id, r.his_name, r.his_champion) == (999, "", "None")


def test_last_participant_with_my_name_wins(spark):
    # tracked player 1 appears twice: participant 0 (team 100) and 3 (team 200)
    parts = [(1, 0, 1, 1, 100), (1, 1, 2, 2, 100), (1, 2, 3, 3, 200), (1, 3, 1, 5, 200)]
    e = normalize.match_edges(one_match(spark, parts=parts)).collect()
    assert {r.participant_id for r in e} == {1, 2}          # both "me" rows skipped
    assert {r.my_champion for r in e} == {"Champ5"}        # champion of the last one
    got = {r.participant_id: r.competition for r in e}
    assert got == {1: "Against", 2: "Together"}            # team of the last one (200)


def test_fan_out_one_event_per_tracked_player(spark):
    t = match_model(spark, [(1, T0, 10, 100, "Win", 200, "Fail", 1)],
                    [(1, 0, 1, 1, 100), (1, 1, 2, 2, 200)], match_list=[(1, 1), (2, 1)])
    e = normalize.match_edges(t).collect()
    assert {(r.my_id, r.his_id) for r in e} == {(1, 2), (2, 1)}


def test_bans_order_and_unknown(spark):
    t = one_match(spark, bans_=[(1, 2, 5), (1, 1, -1), (1, 3, 500)])
    got = rows(normalize.match_bans(t))
    assert got == [(1, 1, "None"), (1, 2, "Champ5"), (1, 3, "None")]


def test_event_documents_keep_order_and_empty_arrays(spark):
    t = match_model(spark, [(1, T0, 10, 100, "Win", 200, "Fail", 1), (2, T0, 20, 100, "Win", 200, "Fail", 1)],
                    [(1, 0, 1, 1, 100), (1, 3, 4, 4, 200), (1, 2, 3, 3, 200), (1, 1, 2, 2, 100)],
                    [(1, 2, 7), (1, 1, 6)])
    docs = {r.match_id: r for r in normalize.event_documents(t).collect()}
    assert docs[1].bans == ["Champ6", "Champ7"]
    assert [e.hisSummonerName for e in docs[1].edges] == ["P2", "P3", "P4"]
    assert docs[2].bans == [] and docs[2].edges == []


def test_parse_roots_and_quarantine(spark):
    good = '{"gameDuration": 12.9, "winner": "Red", "bans": ["A"], "edges": []}'
    recs = spark.createDataFrame([("k", good), ("k", f"[{good}, {good}]"), ("k", "oops"),
                                  ("k", '{"winner": "Red"}'), ("k", None)], "key string, value string")
    p = documents.parse_events(recs).select("value", "quarantined", "_event.gameDuration").collect()
    q = [r.quarantined for r in p]
    assert q == [False, False, True, True, True]
    assert [r.gameDuration for r in p[:2]] == [12.9, 12.9]
    ok, bad = documents.split_quarantine(documents.parse_events(recs))
    assert ok.count() == 2 and bad.count() == 3 and "value" in bad.columns


def test_orientation_and_vertices(spark):
    me = spark.createDataFrame([
        (1, 1, 10, "A", 20, "B", "cA", "cB", "Win", "Against"),
        (1, 2, 10, "A", 30, "C", "cA", "cC", "Fail", "Against"),
        (2, 1, 20, "B", 10, "A", "cB", "cA", "Other", "Together"),
        (2, 2, 20, "B", 40, "", "cB", "cD", "Fail", "Against"),
    ], schemas.MATCH_EDGE)
    e = rows(graph.oriented_edges(me))
    assert e == sorted([(10, 20, "cA", "cB", "Against"), (30, 10, "cA", "cC", "Against"),
                        (20, 10, "cB", "cA", "Together"), (40, 20, "cB", "cD", "Against")])
    flipped = rows(graph.oriented_edges(me, orientation="winner_to_loser"))
    assert (20, 10, "cA", "cB", "Against") in flipped
    v = rows(graph.extract_vertices(me))
    assert (20, "B", True) in v and (20, "B", False) in v and all(r[0] != 40 for r in v)
    g = graph.graph_from_match_edges(me)
    gv = {r.id: (r.name, r.tracking) for r in g.vertices.collect()}
    assert gv == {10: ("A", True), 20: ("B", True), 30: ("C", False), 40: ("Missing", False)}
    # the two graph constructions agree
    g2 = graph.build_graph(graph.extract_vertices(me), graph.oriented_edges(me))
    assert rows(g2.vertices) == rows(g.vertices)


def test_build_graph_missing_endpoint(spark):
    v = spark.createDataFrame([(1, "a", True), (1, "a", False)], schemas.VERTEX)
    e = spark.createDataFrame([(1, 9, "x", "y", "Against")], schemas.EDGE)
    got = rows(graph.build_graph(v, e).vertices)
    assert got == [(1, "a", True), (9, "Missing", False)]


def test_top_k_ties_and_exclusion(spark):
    bc = spark.createDataFrame([("-1", 100), ("b", 5), ("a", 5), ("c", 5), ("d", 1)], schemas.BAN_COUNT)
    assert [r.champion for r in bans.top_banned(bc, 3).collect()] == ["a", "b", "c"]
    assert [r.champion for r in bans.top_banned(bc, 3, exclude=()).collect()] == ["-1", "a", "b"]
    chart = [r.champion for r in marts.top_bans_chart(bc, 2).collect()]
    assert chart == ["b", "a"]  # ascending display order


def test_banned_subgraph_degrees_and_hop(spark):
    e = spark.createDataFrame([
        (1, 2, "X", "Y", "Against"), (2, 3, "Y", "Z", "Against"), (3, 1, "X", "Q", "Together"),
        (4, 1, "Q", "Y", None)], schemas.EDGE)
    v = spark.createDataFrame([(1, "a", True), (2, "b", True), (3, "c", False), (4, "d", True)], schemas.VERTEX)
    g = graph.build_graph(v, e)
    top = spark.createDataFrame([("Y", 9)], schemas.BAN_COUNT)
    sub = graph.banned_subgraph(g, top)
    assert rows(sub.edges) == [(1, 2, "X", "Y", "Against"), (2, 3, "Y", "Z", "Against")]
    d = {r.id: (r.in_degree, r.out_degree) for r in graph.with_degrees(sub).collect()}
    assert d == {1: (0, 1), 2: (1, 1), 3: (1, 0), 4: (0, 0)}
    assert rows(graph.tracked_with_edges(sub)) == [(1, "a", True, 0, 1), (2, "b", True, 1, 1)]
    assert rows(graph.pattern_hop(sub, top)) == [(1, "a", 2, "X")]


def test_running_count_blocks_match_plain_window(spark):
    # a hot champion spread over many blocks, block size 3 ids
    data = [(m, p, "hot" if (m + p) % 4 else "cold") for m in range(1, 40) for p in range(1, 4)]
    mb = spark.createDataFrame(data, "match_id long, pos int, champion string")
    got = rows(bans.running_ban_count(mb, blocks=13))
    pdf = pd.DataFrame(data, columns=["match_id", "pos", "champion"]).sort_values(["match_id", "pos"])
    pdf["running"] = pdf.groupby("champion").cumcount() + 1
    assert got == sorted(map(tuple, pdf.itertuples(index=False)))


def test_marts_from_matches_and_slots(spark):
    ev = spark.createDataFrame([(T0, 600, "Red"), (T0, 1200, "Blue"), (T0, 1800, "Red")],
                               "ts timestamp_ntz, game_duration long, winner string")
    (a,) = marts.avg_length(ev).collect()
    assert (a.total_length, a.total_matches, a.avg_min, a.delta_min) == (3600, 3, 20.0, -5.0)
    ws = {r.side: (r.wins, r.share) for r in marts.win_share(ev).collect()}
    assert ws == {"Red Side": (2, 0.666667), "Blue Side": (1, 0.333333)}
    empty = ev.limit(0)
    (e,) = marts.avg_length(empty).collect()
    assert e.avg_min is None  # no division by zero
    slots = spark.createDataFrame([(T0, 100, 1, 2), (T0, 200, 0, 2)], schemas.MATCH_STATS)
    (s,) = marts.avg_length(slots, source="slots").collect()
    assert (s.total_length, s.total_matches) == (300, 4)


def test_name_hash_parity_values():
    s = pd.Series(["abc", "", "a", "Master Yi", "\U0001F600k", None])
    assert murmur3_string_hash(s).tolist()[:5] == [-112296174, 377927480, -1454233464, -857118976, 2108786932]
    assert murmur3_string_hash(s).isna().tolist()[5]


def test_name_hash_udf_in_spark(spark):
    from skirmish.functions.hashing import name_id
    df = spark.createDataFrame([("abc",), ("Master Yi",), (None,)], "n string")
    got = [r.h for r in df.select(name_id("n", "murmur3").alias("h")).collect()]
    assert got == [-112296174, -857118976, None]


def test_csv_names_survive_roundtrip(spark):
    path = scratch_path(spark, "csv-names")
    v = spark.createDataFrame([(1, " x ", True), (2, 'a,b"c', False), (3, "", False), (4, None, True)],
                              schemas.VERTEX)
    graph_files.write_graph_file(v, path, "csv")
    assert rows(graph_files.read_vertices(spark, path, "csv")) == rows(v)


def test_edge_file_skipped_when_empty(spark):
    path = scratch_path(spark, "empty-edges")
    e = spark.createDataFrame([], schemas.EDGE)
    assert graph_files.write_graph_file(e, path, "csv", skip_empty=True) is False


def test_champion_csv_extra_fields(spark):
    path = scratch_path(spark, "champs")
    spark.createDataFrame([("1,Annie",), ("2,Olaf,extra",)], "value string").write.text(path)
    assert rows(documents.read_champion_csv(spark, path)) == [(1, "Annie"), (2, "Olaf")]


def test_name_ids_and_unknown_players_share_a_vertex(spark):
    me = spark.createDataFrame([
        (1, 1, 10, "A", 20, "", "cA", "cB", "Win", "Against"),
        (1, 2, 10, "A", 30, "", "cA", "cC", "Win", "Against"),
        (2, 1, 40, "Master Yi", 10, "A", "cD", "cA", "Fail", "Against"),
    ], schemas.MATCH_EDGE)
    v = rows(graph.extract_vertices(me, id_mode="murmur3", keep_empty_names=True))
    ids = {name: i for i, name, _ in v}
    assert ids["Master Yi"] == -857118976 and ids[""] == 377927480
    assert sum(1 for r in v if r[1] == "") == 1   # every unknown opponent is the same vertex
    assert not any(r[1] == "" for r in rows(graph.extract_vertices(me, id_mode="murmur3")))
    g = graph.graph_from_match_edges(me, id_mode="xxhash64")
    assert g.vertices.count() == 3  # A, Master Yi, and one id shared by both unknown opponents


def test_time_arithmetic_ignores_session_time_zone(spark):
    from skirmish.functions.columns import epoch_micros_to_ntz, ntz_to_epoch_micros
    from skirmish.operators import matchlist
    q = """SELECT * FROM VALUES
      (1, TIMESTAMP_NTZ'2024-03-09 23:00:00', 1, 'a'), (2, TIMESTAMP_NTZ'2024-03-10 02:30:00', 1, 'a'),
      (3, TIMESTAMP_NTZ'2024-03-10 05:00:00', 1, 'a'), (4, TIMESTAMP_NTZ'2024-11-03 01:30:00.123456', 1, 'a'),
      (5, TIMESTAMP_NTZ'2024-03-08 00:00:00', 1, 'a') AS t(event_id, ts, user_id, event_type)"""
    out = {}
    for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        try:
            ev = spark.sql(q)
            out[tz] = rows(matchlist.match_list_slices(ev, ev.agg(F.min("ts")).scalar()))
            back = ev.select("ts", epoch_micros_to_ntz(ntz_to_epoch_micros("ts")).alias("rt"))
            assert back.filter(F.col("ts") != F.col("rt")).count() == 0
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out["UTC"] == out["America/Los_Angeles"] == out["Asia/Kolkata"]
    assert [r[1] for r in sorted(out["UTC"], key=lambda r: r[5])] == [19, 21, 22, 2400, 0]
