"""Structured Streaming: batch = stream, restart from checkpoint, sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from skirmish import schemas
from skirmish.operators import bans, normalize, stats
from skirmish.session import scratch_path
from skirmish.sources import documents, graph_files, tables
from skirmish.streaming import jobs
from skirmish.streaming.store import UpsertStore
from tests.conftest import SF_SMALL
from tests.util import rows

AVAILABLE_NOW = {"availableNow": True}


def publish(spark, t, path, files):
    normalize.to_records(normalize.event_documents(t)).repartition(files).write.mode("overwrite").json(path)


def test_ban_stream_equals_batch_and_survives_restart(spark, small_tables):
    root = scratch_path(spark, "t-ban")
    # two halves of the topic (by match id parity) land at different times
    store = UpsertStore(spark, f"{root}/ban_count", ["champion"], schemas.BAN_COUNT).create().truncate()
    docs = normalize.event_documents(small_tables)
    first = normalize.to_records(docs.filter(F.col("match_id") % 2 == 0))
    second = normalize.to_records(docs.filter(F.col("match_id") % 2 == 1))
    first.repartition(3).write.mode("append").json(f"{root}/topic")
    q = jobs.start_ban_counts(documents.json_record_stream(spark, f"{root}/topic", 1), store,
                              f"{root}/ckpt", AVAILABLE_NOW)
    jobs.run_available(q)
    second.repartition(2).write.mode("append").json(f"{root}/topic")
    q = jobs.start_ban_counts(documents.json_record_stream(spark, f"{root}/topic", 1), store,
                              f"{root}/ckpt", AVAILABLE_NOW)  # same checkpoint: resumes
    jobs.run_available(q)
    expected = bans.ban_counts(normalize.match_bans(small_tables))
    assert rows(store.read()) == rows(expected)


def test_stats_stream_equals_batch(spark):
    root = scratch_path(spark, "t-stats")
    ev = tables.read_table(spark, SF_SMALL, "events")
    src = tables.events_as_matches(
        spark.readStream.schema(ev.schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL))
    store = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create().truncate()
    jobs.run_available(jobs.start_sliding_stats(src, store, f"{root}/ckpt", trigger=AVAILABLE_NOW))
    assert rows(store.read()) == rows(stats.sliding_stats(tables.events(spark, SF_SMALL)))


def test_match_event_sink_fan_out(spark, small_tables):
    root = scratch_path(spark, "t-sink")
    publish(spark, small_tables, f"{root}/topic", 3)
    # a malformed record among them
    spark.createDataFrame([("x", "oops")], "key string, value string").write.mode("append").json(f"{root}/topic")
    totals = UpsertStore(spark, f"{root}/totals", ["champion"], schemas.BAN_COUNT).create().truncate()
    sink = jobs.MatchEventSink(f"{root}/edges", f"{root}/vertices", f"{root}/running", f"{root}/quarantine",
                               totals, id_mode="key")
    q = jobs.start_match_event_sink(documents.json_record_stream(spark, f"{root}/topic", 1), sink,
                                    f"{root}/ckpt", AVAILABLE_NOW)
    jobs.run_available(q)
    me = normalize.match_edges(small_tables)
    from skirmish.operators import graph
    got_edges = graph_files.read_edges(spark, f"{root}/edges")
    assert rows(got_edges) == rows(graph.oriented_edges(me))
    got_v = graph_files.read_vertices(spark, f"{root}/vertices").distinct()
    assert rows(got_v) == rows(graph.extract_vertices(me))
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    # per-ban running totals across micro-batches: each champion gets 1..n exactly once
    run = spark.read.parquet(f"{root}/running")
    per = run.groupBy("champion").agg(F.count(F.lit(1)).alias("n"), F.max("running").alias("mx"),
                                     F.countDistinct("running").alias("d"), F.min("running").alias("mn"))
    assert per.filter((F.col("n") != F.col("mx")) | (F.col("d") != F.col("n")) | (F.col("mn") != 1)).count() == 0
    assert rows(totals.read()) == rows(bans.ban_counts(normalize.match_bans(small_tables)))


def test_upsert_store_partial_columns_and_replay(spark):
    root = scratch_path(spark, "t-store")
    s = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create()
    import datetime as dt
    t1, t2 = dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 5)
    s.upsert(spark.createDataFrame([(t1, 10), (t2, 20)], "slot timestamp_ntz, duration long"), 0, part=0)
    s.upsert(spark.createDataFrame([(t1, 1)], "slot timestamp_ntz, red_win long"), 0, part=1)
    s.upsert(spark.createDataFrame([(t1, 3), (t2, 4)], "slot timestamp_ntz, tot_matches long"), 0, part=2)
    s.upsert(spark.createDataFrame([(t1, 11)], "slot timestamp_ntz, duration long"), 1)
    s.upsert(spark.createDataFrame([(t1, 99)], "slot timestamp_ntz, duration long"), 2)
    s.upsert(spark.createDataFrame([(t1, 12)], "slot timestamp_ntz, duration long"), 2)  # replay of batch 2
    assert rows(s.read()) == [(t1, 12, 1, 3), (t2, 20, None, 4)]
    assert rows(s.read(before_batch=2)) == [(t1, 11, 1, 3), (t2, 20, None, 4)]
    s.truncate()
    assert s.read().count() == 0
    # after a reset a fresh checkpoint counts batches from 0 again; nothing of the previous run is left
    s.upsert(spark.createDataFrame([(t2, 7)], "slot timestamp_ntz, duration long"), 0)
    assert rows(s.read()) == [(t2, 7, None, None)]


def test_upsert_store_versions_expire_and_half_written_ones_are_not_read(spark):
    root = scratch_path(spark, "t-versions")
    s = UpsertStore(spark, f"{root}/t", ["champion"], schemas.BAN_COUNT, keep=3).create()
    reader = None
    for batch in range(6):
        s.upsert(spark.createDataFrame([("A", batch), (f"c{batch}", 1)], schemas.BAN_COUNT), batch)
        if batch == 4:
            reader = s.read()  # somebody reads while the next version is written
    assert len(s.versions()) == 3
    assert dict(rows(s.read()))["A"] == 5 and s.read().count() == 7
    assert dict(rows(reader))["A"] == 4
    # a version without the success marker (a write that was cut off) is ignored
    fs, path = s._fs()
    fs.delete(path(f"{s._folder(s.versions()[-1])}/_SUCCESS"), False)
    assert dict(rows(s.read()))["A"] == 4
    s.upsert(spark.createDataFrame([("A", 5), ("c5", 1)], schemas.BAN_COUNT), 5)  # the batch is replayed
    assert dict(rows(s.read()))["A"] == 5 and s.read().count() == 7


def test_null_ban_is_counted_and_numbered(spark):
    b = spark.createDataFrame([(1, 1, None), (2, 1, None), (3, 1, "A")], "match_id long, pos int, champion string")
    got = sorted((r.match_id, r.champion, r.running) for r in bans.running_ban_count(b).collect())
    assert got == [(1, None, 1), (2, None, 2), (3, "A", 1)]
    root = scratch_path(spark, "t-null-ban")
    totals = UpsertStore(spark, f"{root}/totals", ["champion"], schemas.BAN_COUNT).create()
    sink = jobs.MatchEventSink(f"{root}/e", f"{root}/v", f"{root}/r", f"{root}/q", totals)
    sink._running(b, 0)
    sink._running(b, 1)
    assert {(r.champion, r.ban_count) for r in totals.read().collect()} == {(None, 4), ("A", 2)}


def reference_events(spark, root, texts):
    spark.createDataFrame([("k", t) for t in texts], "key string, value string").write.json(f"{root}/topic")
    return documents.json_record_stream(spark, f"{root}/topic")


def test_events_as_the_reference_publishes_them(spark):
    """No id, no time, opaque player ids: nothing is lost and no id is null."""
    import json
    root = scratch_path(spark, "t-payload")
    edge = {"hisSummonerId": "xYz_1", "hisSummonerName": "Bo", "myChampionId": "Annie", "mySummonerID": "aCc-9",
            "mySummonerName": "Ann", "hisChampionId": "Olaf", "outcome": "Fail", "competition": "Against"}
    event = {"gameDuration": 100.0, "winner": "Red", "bans": ["Zed"], "edges": [edge]}
    qs = jobs.start_match_jobs(reference_events(spark, root, [json.dumps(event)] * 2), f"{root}/out", trigger=AVAILABLE_NOW)
    for q in qs.values():
        jobs.run_available(q)
    st = UpsertStore(spark, f"{root}/out/stats", ["slot"], schemas.MATCH_STATS).read().collect()
    assert len(st) == 6 and {(r.duration, r.red_win, r.tot_matches) for r in st} == {(200, 2, 2)}
    e = graph_files.read_edges(spark, f"{root}/out/edges").collect()
    assert len(e) == 2 and all(r.src_id is not None and r.dst_id is not None and r.src_id != r.dst_id for r in e)
    v = graph_files.read_vertices(spark, f"{root}/out/vertices").distinct().collect()
    assert {r.name for r in v} == {"Ann", "Bo"} and {r.id for r in v} == {r.src_id for r in e} | {r.dst_id for r in e}


def test_bad_records_are_quarantined_and_never_stop_the_stream(spark):
    import json
    root = scratch_path(spark, "t-bad")
    good = {"match_id": 1, "ts": "2024-01-01 00:00:00", "gameDuration": 5.0, "winner": "Blue", "bans": [], "edges": []}
    edge = {"hisSummonerId": "1", "hisSummonerName": "B", "myChampionId": "a", "mySummonerID": "2", "mySummonerName": "A",
            "hisChampionId": "b", "competition": "Against"}  # no outcome
    bad = [good | {"ts": "not a time"}, good | {"gameDuration": 1e30}, good | {"edges": [edge]}, {"winner": "Red"}]
    qs = jobs.start_match_jobs(reference_events(spark, root, [json.dumps(x) for x in [good, *bad]] + ["junk"]),
                               f"{root}/out", trigger=AVAILABLE_NOW)
    for q in qs.values():
        jobs.run_available(q)
    assert spark.read.parquet(f"{root}/out/quarantine").count() == 5
    st = UpsertStore(spark, f"{root}/out/stats", ["slot"], schemas.MATCH_STATS).read()
    assert {(r.duration, r.tot_matches) for r in st.collect()} == {(5, 1)}


def test_event_files_in_a_folder_and_out_of_order(spark, tmp_path):
    from skirmish.plans.queries import stats_sliding_stream
    ev = tables.read_table(spark, SF_SMALL, "events")
    expected = rows(stats.sliding_stats(tables.events_as_matches(ev)))
    ev.repartition(4).write.parquet(f"{tmp_path}/folder/events.parquet")
    assert rows(stats_sliding_stream(spark, f"{tmp_path}/folder")) == expected
    # newest first, one file per micro-batch
    days = ev.select(F.date_trunc("day", "ts").alias("d")).distinct().orderBy(F.desc("d")).collect()
    cuts = [days[len(days) * k // 4].d for k in range(4)]
    root = scratch_path(spark, "t-order")
    store = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create()
    upper = None
    for k, cut in enumerate(cuts[1:] + [None]):
        part = ev if cut is None else ev.filter(F.col("ts") >= F.lit(cut).cast("timestamp_ntz"))
        if upper is not None:
            part = part.filter(F.col("ts") < F.lit(upper).cast("timestamp_ntz"))
        part.coalesce(1).write.parquet(f"{root}/in/p{k}")
        upper = cut
        src = tables.events_as_matches(spark.readStream.schema(ev.schema).parquet(f"{root}/in/*"))
        jobs.run_available(jobs.start_sliding_stats(src, store, f"{root}/ckpt", trigger=AVAILABLE_NOW))
    assert rows(store.read()) == expected


def test_stream_then_graph_job_equals_batch_flagship(spark, small_tables):
    from skirmish.operators import graph
    from skirmish.plans.queries import tracked_players_vs_banned
    root = scratch_path(spark, "t-app")
    publish(spark, small_tables, f"{root}/topic", 3)
    # the files are not in time order; without a watermark nothing is late, so the windows must
    # equal the batch result
    qs = jobs.start_match_jobs(documents.json_record_stream(spark, f"{root}/topic", 1), f"{root}/out",
                               trigger=AVAILABLE_NOW, reset=True, id_mode="key")
    for q in qs.values():
        jobs.run_available(q)
    ban_table = UpsertStore(spark, f"{root}/out/ban_count", ["champion"], schemas.BAN_COUNT).read()
    got = graph.graph_job(spark, f"{root}/out/edges", f"{root}/out/vertices", ban_table,
                          export_path=f"{root}/export")
    assert rows(got) == rows(tracked_players_vs_banned(spark, SF_SMALL))
    assert spark.read.parquet(f"{root}/export/nodes").count() > 0
    # the stats table fed from event time equals the batch windows over match events
    st = UpsertStore(spark, f"{root}/out/stats", ["slot"], schemas.MATCH_STATS).read()
    ev = normalize.event_documents(small_tables).select("ts", F.col("gameDuration").cast("bigint")
                                                       .alias("game_duration"), "winner")
    assert rows(st) == rows(stats.sliding_stats(ev))


def test_watermark_drops_late_events(spark):
    import datetime as dt
    root = scratch_path(spark, "t-late")
    t0 = dt.datetime(2024, 1, 1, 12, 0)

    def land(rows_, name):
        (spark.createDataFrame(rows_, "ts timestamp_ntz, game_duration long, winner string")
         .write.mode("overwrite").parquet(f"{root}/in/{name}"))

    land([(t0, 100, "Red")], "a")
    src = spark.readStream.schema("ts timestamp_ntz, game_duration long, winner string").option(
        "maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
    store = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create()
    jobs.run_available(jobs.start_sliding_stats(src, store, f"{root}/ckpt", watermark="10 minutes",
                                                trigger=AVAILABLE_NOW))
    land([(t0 + dt.timedelta(hours=2), 50, "Blue")], "b")      # advances the watermark
    jobs.run_available(jobs.start_sliding_stats(src, store, f"{root}/ckpt", watermark="10 minutes",
                                                trigger=AVAILABLE_NOW))
    land([(t0 + dt.timedelta(minutes=1), 7, "Red")], "c")      # 2 h late: dropped
    jobs.run_available(jobs.start_sliding_stats(src, store, f"{root}/ckpt", watermark="10 minutes",
                                                trigger=AVAILABLE_NOW))
    total = store.read().agg(F.sum("tot_matches").alias("n"), F.sum("duration").alias("d")).first()
    assert (total.n, total.d) == (12, 6 * 150)


def test_graph_job_over_csv_files(spark, small_tables):
    from skirmish.operators import graph
    from skirmish.plans.queries import tracked_players_vs_banned
    root = scratch_path(spark, "t-csv")
    publish(spark, small_tables, f"{root}/topic", 2)
    totals = UpsertStore(spark, f"{root}/totals", ["champion"], schemas.BAN_COUNT).create()
    sink = jobs.MatchEventSink(f"{root}/edges", f"{root}/vertices", f"{root}/running", f"{root}/q", totals,
                               fmt="csv", id_mode="key")
    jobs.run_available(jobs.start_match_event_sink(documents.json_record_stream(spark, f"{root}/topic", 1),
                                                   sink, f"{root}/ckpt", AVAILABLE_NOW))
    got = graph.graph_job(spark, f"{root}/edges", f"{root}/vertices", totals.read(), fmt="csv")
    assert rows(got) == rows(tracked_players_vs_banned(spark, SF_SMALL))


def test_command_line_stream_graph_marts(spark, small_tables):
    from skirmish.__main__ import main
    from skirmish.plans.queries import tracked_players_vs_banned
    root = scratch_path(spark, "t-cli")
    publish(spark, small_tables, f"{root}/topic", 2)
    main(["stream", "--json-dir", f"{root}/topic", "--root", f"{root}/out", "--available-now",
          "--id-mode", "key"])
    main(["graph", "--root", f"{root}/out", "--export", f"{root}/graph"])
    main(["marts", "--root", f"{root}/out"])
    got = spark.read.parquet(f"{root}/out/tracked_vs_banned")
    assert rows(got) == rows(tracked_players_vs_banned(spark, SF_SMALL))
    share = {r.side: r.wins for r in spark.read.parquet(f"{root}/out/marts/win_share").collect()}
    assert set(share) == {"Red Side", "Blue Side"}


def test_arrival_time_windows_and_match_dedupe(spark, small_tables):
    root = scratch_path(spark, "t-arrival")
    docs = normalize.event_documents(small_tables)
    recs = normalize.to_records(docs)
    recs.unionByName(recs).coalesce(1).write.json(f"{root}/topic")   # every match reported twice
    n = docs.count()
    # processing time: one micro-batch, so every match lands in the same six slots
    st = UpsertStore(spark, f"{root}/a", ["slot"], schemas.MATCH_STATS).create()
    jobs.run_available(jobs.start_sliding_stats(
        jobs.event_matches(documents.json_record_stream(spark, f"{root}/topic")), st, f"{root}/ck-a",
        trigger=AVAILABLE_NOW, time_basis="arrival"))
    got = st.read().collect()
    assert len(got) == 6 and {r.tot_matches for r in got} == {2 * n}
    # event time with de-duplication on match id: each match counted once per window
    st2 = UpsertStore(spark, f"{root}/b", ["slot"], schemas.MATCH_STATS).create()
    jobs.run_available(jobs.start_sliding_stats(
        jobs.event_matches(documents.json_record_stream(spark, f"{root}/topic")), st2, f"{root}/ck-b",
        trigger=AVAILABLE_NOW, dedupe_key="match_id"))
    ev = docs.select("ts", F.col("gameDuration").cast("bigint").alias("game_duration"), "winner")
    assert rows(st2.read()) == rows(stats.sliding_stats(ev))
