"""Document sources (match lists, league entries, accounts, raw matches),
incremental polling and the optional semantics switches."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from skirmish.operators import matchlist, normalize, stats
from skirmish.session import scratch_path
from skirmish.sources import documents
from tests.util import match_model, rows

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def write_lines(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_match_list_pages(spark):
    path = scratch_path(spark, "lists")
    page = {"accountId": "acc1", "endIndex": 2, "matches": [
        {"gameId": 11, "queue": 420, "timestamp": 1}, {"gameId": 12, "queue": 420, "timestamp": 2},
        {"gameId": 13, "queue": 420, "timestamp": 3}]}
    write_lines(spark, path, [json.dumps(page), json.dumps({"accountId": "acc2", "endIndex": 0, "matches": []})])
    got = rows(documents.explode_match_lists(documents.read_match_lists(spark, path)))
    assert got == [("acc1", 0, 11, 420, 1), ("acc1", 1, 12, 420, 2)]  # only 0..endIndex-1


def test_roster_and_accounts(spark):
    lp, ap = scratch_path(spark, "league"), scratch_path(spark, "accounts")
    write_lines(spark, lp, [json.dumps([{"summonerName": "Ann Lee"}, {"summonerName": "Bo"}]),
                            json.dumps([{"summonerName": "Cy"}])])
    write_lines(spark, ap, [json.dumps({"name": "Ann Lee", "accountId": "a1"}),
                            json.dumps({"name": "Bo", "accountId": "b1"}),
                            json.dumps({"name": "Bo", "accountId": "b2"})])
    entries = documents.read_league_entries(spark, lp).withColumn("rating", F.length("summoner_name"))
    ros = matchlist.roster(entries, n=2)
    got = rows(matchlist.resolve_accounts(ros, documents.read_accounts(spark, ap)))
    # top 2 by rating: "Ann Lee" (7), then "Bo"/"Cy" (2) -> "Bo" by name; last account wins
    assert got == [("Ann Lee", "Ann%20Lee", "a1", 7), ("Bo", "Bo", "b2", 2)]


def test_raw_documents_roundtrip_small(spark):
    t = match_model(spark, [(1, T0, 1800, 100, "Win", 200, "Fail", 1)],
                    [(1, 0, 1, 1, 100), (1, 1, 2, 2, 100), (1, 2, 99, 3, 200)], [(1, 1, 4), (1, 2, -1)])
    path = scratch_path(spark, "raw-small")
    documents.to_raw_documents(t).write.json(path)
    flat = documents.flatten_raw_matches(documents.read_raw_matches(spark, path), t.champions, t.players,
                                         t.match_list)
    assert rows(normalize.match_edges(flat)) == rows(normalize.match_edges(t))
    assert rows(normalize.match_bans(flat)) == rows(normalize.match_bans(t))
    assert rows(normalize.match_events(flat)) == rows(normalize.match_events(t))


def test_identity_lookup_inside_document(spark):
    doc = {"gameId": 5, "gameCreation": 0, "gameDuration": 61.7,
           "teams": [{"teamId": 100, "win": "Fail", "bans": []}, {"teamId": 200, "win": "Win", "bans": []}],
           "participants": [{"participantId": 1, "championId": 1, "teamId": 100},
                            {"participantId": 2, "championId": 2, "teamId": 200}],
           "participantIdentities": [{"participantId": 1, "player": {"summonerId": "7", "summonerName": "Me"}}]}
    path = scratch_path(spark, "raw-one")
    write_lines(spark, path, [json.dumps(doc)])
    t = match_model(spark, [], [], players=[(7, "Me", True)], match_list=[(7, 5)])
    flat = documents.flatten_raw_matches(documents.read_raw_matches(spark, path), t.champions, t.players,
                                         t.match_list)
    (e,) = normalize.match_edges(flat).collect()
    # participant 2 has no identity: empty id/name; game duration truncated
    assert (e.his_id, e.his_name, e.outcome, e.competition) == (None, "", "Win", "Against")
    assert normalize.match_events(flat).first().game_duration == 61


def test_tracked_participant_is_the_last_in_the_identity_list(spark):
    who = lambda pid, name: {"participantId": pid, "player": {"summonerId": str(pid), "summonerName": name}}
    doc = {"gameId": 5, "gameCreation": 0, "gameDuration": 60.0,
           "teams": [{"teamId": 100, "win": "Fail", "bans": []}, {"teamId": 200, "win": "Win", "bans": []}],
           "participants": [{"participantId": p, "championId": p, "teamId": 100 if p != 2 else 200} for p in (1, 2, 3)],
           "participantIdentities": [who(2, "Me"), who(1, "Me"), who(3, "You")]}
    path = scratch_path(spark, "raw-order")
    write_lines(spark, path, [json.dumps(doc)])
    t = match_model(spark, [], [], players=[(1, "Me", True)], match_list=[(1, 5)])
    flat = documents.flatten_raw_matches(documents.read_raw_matches(spark, path), t.champions, t.players, t.match_list)
    (e,) = normalize.match_edges(flat).collect()
    assert (e.my_champion, e.competition, e.his_name) == ("Champ1", "Together", "You")


def test_junk_documents_give_no_match(spark):
    path = scratch_path(spark, "raw-junk")
    write_lines(spark, path, ["junk", "{}", json.dumps({"gameId": 1, "gameDuration": 1e30, "teams": [], "participants": []})])
    docs = documents.read_raw_matches(spark, path)
    good, bad = documents.split_raw_matches(docs)
    assert good.count() == 0 and bad.count() == 3
    assert bad.filter(F.col(documents.CORRUPT).isNotNull()).count() == 1
    t = match_model(spark, [], [])
    assert documents.flatten_raw_matches(docs, t.champions, t.players, t.match_list).matches.count() == 0


def test_slices_and_polls_keep_games_without_a_player(spark):
    ev = spark.createDataFrame([(1, T0, None, "a"), (2, T0, 7, "a"), (3, T0 + dt.timedelta(minutes=1), None, "a")],
                               "event_id long, ts timestamp_ntz, user_id long, event_type string")
    got = sorted((r.game_id, r.idx, r.end_index) for r in matchlist.match_list_slices(ev, F.lit(T0).cast("timestamp_ntz")).collect())
    assert got == [(1, 0, 2), (2, 0, 1), (3, 1, 2)]
    g = ev.select(F.col("user_id").alias("player"), F.col("event_id").alias("game_id"), "ts")
    cursor = spark.createDataFrame([(None, T0)], "player long, last_ts timestamp_ntz")
    new, _ = matchlist.poll_increment(g, cursor, F.lit(T0).cast("timestamp_ntz"))
    assert sorted(r.game_id for r in new.collect()) == [2, 3]


def test_poll_increment_high_water_mark(spark):
    g = spark.createDataFrame([(1, 10, T0), (1, 11, T0 + dt.timedelta(hours=1)), (2, 20, T0),
                               (3, 30, T0 - dt.timedelta(days=1))], "player long, game_id long, ts timestamp_ntz")
    cursor = spark.createDataFrame([(1, T0)], "player long, last_ts timestamp_ntz")
    begin = F.lit(T0 - dt.timedelta(hours=2)).cast("timestamp_ntz")
    new, adv = matchlist.poll_increment(g, cursor, begin)
    assert sorted(r.game_id for r in new.collect()) == [11, 20]
    assert rows(adv) == [(1, T0 + dt.timedelta(hours=1)), (2, T0)]
    new2, _ = matchlist.poll_increment(g, adv, begin)
    assert new2.count() == 0


def test_match_list_slices_queue_and_positions(spark):
    ev = spark.createDataFrame([
        (1, T0, 7, "a"), (2, T0 + dt.timedelta(minutes=1), 7, "a"), (3, T0 + dt.timedelta(hours=3), 7, "a"),
        (4, T0 + dt.timedelta(minutes=2), 7, "b"), (5, T0 - dt.timedelta(minutes=1), 7, "a")],
        "event_id long, ts timestamp_ntz, user_id long, event_type string")
    got = [(r.poll, r.idx, r.game_id, r.end_index)
           for r in matchlist.match_list_slices(ev, F.lit(T0).cast("timestamp_ntz"), queue="a")
           .orderBy("game_id").collect()]
    assert got == [(0, 0, 1, 2), (0, 1, 2, 2), (1, 0, 3, 1)]


def test_dedupe_and_remake_switches(spark):
    ev = spark.createDataFrame([(1, T0, 600, "Red"), (1, T0, 600, "Red"), (2, T0, 60, "Blue")],
                               "match_id long, ts timestamp_ntz, game_duration long, winner string")
    twice = {r.slot: r.tot_matches for r in stats.sliding_stats(ev).collect()}
    once = {r.slot: r.tot_matches for r in stats.sliding_stats(ev, dedupe_key="match_id").collect()}
    assert set(twice.values()) == {3} and set(once.values()) == {2} and len(once) == 6
    t = match_model(spark, [(1, T0, 1, 100, "Fail", 200, "Fail", 1), (2, T0, 1, 100, "Win", 200, "Fail", 1)], [])
    got = {r.match_id: (r.winner, r.remake) for r in normalize.match_events(t, flag_remake=True).collect()}
    assert got == {1: ("Red", True), 2: ("Blue", False)}
