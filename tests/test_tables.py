"""Tables kept up to date by micro-batches: buckets, commits, folds, polls, exports, panes and operator state."""

from __future__ import annotations

import datetime as dt
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from skirmish import schemas
from skirmish.functions.hashing import murmur3_string_hash, name_id
from skirmish.functions.ranking import range_row_number
from skirmish.operators import bans, graph, matchlist, normalize, stats
from skirmish.session import scratch_path
from skirmish.sources import documents, graph_files, tables
from skirmish.streaming import jobs
from skirmish.streaming.graph_tables import ExportStore, GraphTables
from skirmish.streaming.store import UpsertStore
from skirmish.streaming.versions import BucketStore, Keyed
from tests.conftest import SF_SMALL
from tests.util import rows

NOW = {"availableNow": True}
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def edges(spark, small_tables):
    return normalize.match_edges(small_tables).cache()


# ---- buckets --------------------------------------------------------------------------------------

def test_graph_tables_equal_the_job_over_files(spark, small_tables, edges):
    root = scratch_path(spark, "t-graph")
    live = GraphTables(spark, f"{root}/tables", buckets=8)
    ban_count = bans.ban_counts(normalize.match_bans(small_tables))
    for batch in range(5):
        part = edges.filter(F.pmod("match_id", F.lit(5)) == batch)
        graph_files.write_graph_file(graph.oriented_edges(part), f"{root}/edges/batch_id={batch}")
        graph_files.write_graph_file(graph.extract_vertices(part), f"{root}/vertices/batch_id={batch}")
        live.add(part, batch)
        if batch in (0, 1, 4):
            assert rows(live.job(ban_count)) == rows(graph.graph_job(spark, f"{root}/edges", f"{root}/vertices", ban_count))
    live.add(part, 4)  # the last batch once more
    assert rows(live.job(ban_count)) == rows(graph.graph_job(spark, f"{root}/edges", f"{root}/vertices", ban_count))
    assert rows(live.graph().vertices) == rows(graph.graph_from_match_edges(edges).vertices)
    assert rows(live.read("edges")) == rows(graph.oriented_edges(edges))


def counter(spark, root, buckets=16):
    return BucketStore(spark, root, {"t": Keyed("k BIGINT, n BIGINT, least STRING", ("k",), {"n": F.sum, "least": F.min})}, buckets)


def frame(spark, *r):
    return spark.createDataFrame(list(r), "k bigint, n bigint, least string")


def test_untouched_buckets_keep_their_files_and_replays_change_nothing(spark):
    store = counter(spark, scratch_path(spark, "t-buckets"))
    store.merge({"t": frame(spark, *[(k, 1, f"v{k}") for k in range(200)], (None, 1, None))}, 0)
    before = store.folders("t")
    held = store.read("t")
    store.merge({"t": frame(spark, (7, 5, "a"), (7, 1, "z"))}, 1)
    after = store.folders("t")
    assert sum(before[b] != after[b] for b in before) == 1 and len(before) == 16
    store.merge({"t": frame(spark, (7, 5, "a"), (7, 1, "z"))}, 1)
    assert dict((r.k, (r.n, r.least)) for r in store.read("t").collect()) == {k: (1, f"v{k}") for k in range(200)} | {7: (7, "a"), None: (1, None)}
    assert held.count() == 201 and held.agg(F.sum("n")).first()[0] == 201  # a reader of the old version
    store.merge({"t": spark.createDataFrame([], "k bigint, n bigint, least string")}, 2)
    assert store.folders("t") == store.folders("t", 2000)
    store.expire(keep=1)
    assert len(store.log.versions()) == 1 and store.read("t").agg(F.sum("n")).first()[0] == 207


def test_fold_replay_and_reader_during_the_fold(spark, edges):
    store = GraphTables(spark, scratch_path(spark, "t-fold"), buckets=4)
    own = graph.oriented_edges(edges).limit(24).collect()
    one = lambda k: spark.createDataFrame([own[k]], schemas.EDGE)
    for batch in range(24):
        store.merge({"edges": one(batch)}, batch)
    held = store.read("edges")
    assert not store.fold("edges", at_least=25) and store.fold("edges", at_least=24)
    assert len(store.folders("edges")) == 1
    store.merge({"edges": one(23)}, 23)  # the last batch is replayed after the fold
    want = sorted(map(str, own))
    assert sorted(map(str, store.read("edges").collect())) == want == sorted(map(str, held.collect()))
    store.merge({"edges": one(0)}, 24)
    store.expire(keep=1)
    assert store.read("edges").count() == 25 and len(store.folders("edges")) == 2


def test_export_merges_and_switches_at_once(spark, edges, monkeypatch):
    store = ExportStore(spark, scratch_path(spark, "t-export"), buckets=4)
    whole = graph.graph_from_match_edges(edges)
    first = graph.graph_from_match_edges(edges.filter("match_id % 2 = 0"))
    store.load(first)
    old = rows(store.read("nodes"))
    assert old == rows(graph.export_nodes(first))
    reader = store.read("rels")

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # everything is written, nothing is switched
        m.setattr(store.log, "commit", stop)
        with pytest.raises(RuntimeError):
            store.load(whole)
    assert rows(store.read("nodes")) == old
    store.load(graph.graph_from_match_edges(edges.filter("match_id % 2 = 1")))
    assert rows(reader) == rows(graph.export_relationships(first))
    assert {r.id for r in store.read("nodes").collect()} == {r.id for r in whole.vertices.collect()}
    assert rows(store.read("rels")) == rows(graph.export_relationships(whole))
    store.load(whole)
    assert rows(store.read("rels")) == rows(graph.export_relationships(whole))


def listed(df):
    return sorted(map(str, df.collect()))


def test_poll_neither_skips_nor_repeats_after_a_failure(spark, monkeypatch):
    polls = matchlist.PollStore(spark, scratch_path(spark, "t-polls"), buckets=4)
    games = lambda *r: spark.createDataFrame([(p, g, T0 + dt.timedelta(minutes=m)) for p, g, m in r], "player bigint, game_id bigint, ts timestamp_ntz")
    begin = F.lit(T0).cast("timestamp_ntz")
    assert listed(polls.poll(games((1, 10, 5), (2, 20, 1), (None, 30, 2), (1, 9, -5)), begin)) == listed(games((1, 10, 5), (2, 20, 1), (None, 30, 2)))
    seen = games((1, 10, 5), (2, 20, 1), (None, 30, 2), (1, 11, 6), (3, 31, 0))
    with monkeypatch.context() as m:  # games and marks are written, the commit is lost
        m.setattr(polls.store.log, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            polls.poll(seen, begin)
    assert polls.games().count() == 3
    assert listed(polls.poll(seen, begin)) == listed(games((1, 11, 6), (3, 31, 0)))
    assert polls.poll(seen, begin).count() == 0
    assert listed(polls.games()) == listed(seen)
    assert {r.player: r.last_ts for r in polls.cursor().collect()} == {
        1: T0 + dt.timedelta(minutes=6), 2: T0 + dt.timedelta(minutes=1), 3: T0, None: T0 + dt.timedelta(minutes=2)}


# ---- streams -----------------------------------------------------------------------------------------

def test_panes_with_late_shuffled_and_missing_times(spark):
    root = scratch_path(spark, "t-panes")
    r = random.Random(5)
    data = [(i, T0 + dt.timedelta(seconds=r.randrange(6 * 3600)), r.randrange(100), r.choice(["Red", "Blue"])) for i in range(600)]
    r.shuffle(data)
    schema = "match_id bigint, ts timestamp_ntz, game_duration bigint, winner string"
    panes, store = (UpsertStore(spark, f"{root}/{n}", ["slot"], schemas.MATCH_STATS).create() for n in ("panes", "stats"))
    for k in range(3):  # every part holds times from all over the day, so most of the later ones are late
        part = data[k * 200:(k + 1) * 200] + [(9000 + k, None, 7, "Red")]
        spark.createDataFrame(part, schema).repartition(2).write.parquet(f"{root}/in/{k}")
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
        q = jobs.start_pane_stats(src, panes, store, f"{root}/ckpt", NOW)
        jobs.run_available(q)
    ran = [p for p in q.recentProgress if p["stateOperators"]]
    got = store.read()
    timed = got.filter(F.col("slot") < F.lit(T0 + dt.timedelta(days=2)).cast("timestamp_ntz"))
    frame_ = spark.createDataFrame(data, schema)
    assert rows(timed) == rows(stats.sliding_stats(frame_))
    arrived = got.exceptAll(timed).agg(F.sum("tot_matches"), F.sum("duration")).first()
    assert tuple(arrived) == (18, 126)  # three matches without a time, each in six slots after its arrival
    n_panes = stats.panes(frame_.withColumn("ts", F.col("ts").cast("timestamp"))).count()
    assert n_panes < ran[-1]["stateOperators"][0]["numRowsTotal"] <= n_panes + 3  # one state row per pane


def test_dedupe_keeps_matches_without_an_id(spark):
    schema = "match_id bigint, ts timestamp_ntz, game_duration bigint, winner string"
    data = [(None, T0, i, "Red") for i in range(10)] + [(1, T0, 50, "Blue"), (1, T0, 50, "Blue")]
    (slot, *_) = {(r.duration, r.red_win, r.tot_matches) for r in stats.sliding_stats(spark.createDataFrame(data, schema), dedupe_key="match_id").collect()}
    assert slot == (95, 10, 11)
    root = scratch_path(spark, "t-dedupe")
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{root}/in")
    for start, name in ((jobs.start_sliding_stats, "windows"), (jobs.start_pane_stats, "panes")):
        store = UpsertStore(spark, f"{root}/{name}", ["slot"], schemas.MATCH_STATS).create()
        more = (UpsertStore(spark, f"{root}/p", ["slot"], schemas.MATCH_STATS).create(),) if name == "panes" else ()
        src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        jobs.run_available(start(src, *more, store, f"{root}/c-{name}", trigger=NOW, dedupe_key="match_id"))
        assert {(r.duration, r.red_win, r.tot_matches) for r in store.read().collect()} == {(95, 10, 11)}


def event(bans_, match_id=None):
    return json.dumps({"match_id": match_id, "gameDuration": 10.0, "winner": "Red", "bans": bans_, "edges": []})


def test_running_totals_in_state_survive_a_restart(spark):
    root = scratch_path(spark, "t-running")
    r = random.Random(2)
    total = {}
    for k in range(2):
        texts = [event([r.choice(["HOT", "A", "B", f"c{r.randrange(5)}"]) if r.random() < .66 else "HOT" for _ in range(4)]) for _ in range(150)]
        texts += ["oops"] + [texts[0]] * 20  # equal events count each
        for t in texts:
            for b in json.loads(t)["bans"] if t != "oops" else []:
                total[b] = total.get(b, 0) + 1
        spark.createDataFrame([("x", t) for t in texts], "key string, value string").repartition(3).write.mode("append").json(f"{root}/topic")
        topic = documents.json_record_stream(spark, f"{root}/topic", 2)
        jobs.run_available(jobs.start_running_bans(topic, f"{root}/running", f"{root}/ckpt", NOW))
    seen = {}
    for x in spark.read.parquet(f"{root}/running").collect():
        seen.setdefault(x.champion, []).append(x.running)
    assert {c: sorted(v) for c, v in seen.items()} == {c: list(range(1, n + 1)) for c, n in total.items()}


def test_normalisation_stream_rejects_with_a_reason_and_rereads_dimensions(spark, small_tables):
    root = scratch_path(spark, "t-ingest")
    docs = documents.to_raw_documents(small_tables).cache()
    listed = tables.match_list(spark, SF_SMALL)
    text = F.to_json(F.struct(*docs.columns))
    drop = lambda c: docs.limit(2).select(F.to_json(F.struct(*[x for x in docs.columns if x != c])).alias("value"))
    bad = drop("teams").union(drop("gameId")).union(drop("participants")).union(drop("gameDuration")).union(
        docs.limit(3).select(F.left(text, F.length(text) / 2).alias("value")))
    state = {"match_list": listed.limit(0)}
    for k in range(2):
        part = docs.filter(F.col("gameId") % 2 == k).select(text.alias("value"))
        (part.union(bad) if k else part).coalesce(1).write.text(f"{root}/landed/{k}")
        raw = documents.read_raw_matches(spark, f"{root}/landed/*", streaming=True)
        jobs.run_available(jobs.start_normalisation(
            raw, lambda: (small_tables.champions, small_tables.players, state["match_list"]), jobs.publish_files(f"{root}/topic"),
            f"{root}/rejected", f"{root}/ckpt", NOW))
        state["match_list"] = listed  # known from the second batch on
    good, _ = documents.split_quarantine(documents.parse_events(spark.read.option("recursiveFileLookup", "true").schema("key string, value string").json(f"{root}/topic")))
    want = normalize.match_edges(small_tables).filter("match_id % 2 = 1").drop("participant_id")
    assert rows(documents.event_edges(good).select(*want.columns)) == rows(want)
    reasons = dict(spark.read.parquet(f"{root}/rejected").groupBy("reason").count().collect())
    assert reasons == {"unparsable": 3, "teams": 2, "no game id": 2, "participants": 2, "duration": 2}


# ---- numbering and hashing ------------------------------------------------------------------------------

def test_row_numbers_with_wide_missing_and_tied_order_values(spark):
    r = random.Random(1)
    data = [(r.choice(["HOT", "HOT", "a", None]), r.choice([None, None, -2 ** 62, 2 ** 62 + 5, 1, 7])) for _ in range(3000)]
    df = spark.createDataFrame(data, "k string, o bigint").withColumn("extra", F.lit("x"))
    got = range_row_number(df, ["k"], ["o"], "rn", parts=12).collect()
    assert sorted(map(str, ((x.k, x.o) for x in got))) == sorted(map(str, data))
    per = {}
    for x in got:
        per.setdefault(x.k, []).append((x.rn, x.o))
    for numbered in per.values():
        numbered.sort()
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1))
        order = [-2 ** 63 if o is None else o for _, o in numbered]
        assert order == sorted(order)
    assert range_row_number(df.limit(0), ["k"], ["o"]).count() == 0


def test_a_hot_key_without_order_values_is_cut_into_parts(spark):
    df = spark.range(20000).select(F.lit("HOT").alias("champion"), F.lit(None).cast("bigint").alias("match_id"), F.lit(1).alias("pos"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = bans.running_ban_count(df, blocks=8)
        sizes = [spark.read.parquet(f).count() for f in out.inputFiles()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) < 2 * 20000 / 8 and out.select("running").distinct().count() == 20000


def test_name_hash_without_python(spark):
    r = random.Random(7)
    letters = ["a", "B", " ", "é", "字", "\U0001F600", "\U0010FFFF", "ÿ", "0"]
    names = ["".join(r.choice(letters) for _ in range(r.randrange(20))) for _ in range(500)] + ["", None, "x" * 3000]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", name_id("n", "murmur3").alias("h"))
    want = murmur3_string_hash(pd.Series(names, dtype=object))
    assert [x.h for x in df.collect()] == [None if pd.isna(w) else int(w) for w in want]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
