"""Registered queries: one per operator group of the blueprint.

Each callable takes (spark, sf_dir) and returns a DataFrame over the whole
input tables.  Queries that exercise a sink (CSV / Parquet files, upsert
tables, streams) run that write into a fresh folder below the shared
checkpoint directory and return a lazy read of what was written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import columns as colfn
from ..functions.hashing import name_id
from ..operators import bans, graph, marts, matchlist, normalize, stats
from ..session import GZIP_PER_CORE, clean_shuffles, materialize, scratch_path, trigger_bytes
from ..sources import documents, graph_files, match_store, tables
from ..streaming import jobs
from ..streaming.graph_tables import ExportStore, GraphTables
from ..streaming.store import UpsertStore

Query = Callable[[SparkSession, str], DataFrame]


# ---- shared building blocks ---------------------------------------------------

def _t(spark: SparkSession, d: str) -> tables.MatchTables:
    return tables.load(spark, d)


def _edges(spark, d) -> DataFrame:
    return normalize.match_edges(_t(spark, d))


def _ban_count(spark, d) -> DataFrame:
    t = _t(spark, d)
    return bans.ban_counts_by_key(t.bans, t.champions)


def _graph(spark, d, both_sides: bool = True) -> graph.PropertyGraph:
    """Graph over the normalised edges.

    When a query consumes both vertices and edges, the normalised edges are
    written once (like the edge files of the streaming job) so the two sides
    do not both recompute them; a query using one side reads them directly.
    """
    me = _edges(spark, d).select("my_id", "my_name", "his_id", "his_name", "my_champion", "his_champion",
                                 "outcome", "competition")  # what the graph reads
    return graph.graph_from_match_edges(materialize(me, "match-edges") if both_sides else me)


def _banned(spark, d, both_sides: bool = True) -> tuple[graph.PropertyGraph, F.Column]:
    """Banned subgraph and the top-k champion set it was cut with (one
    subquery, reused by whoever needs the set again)."""
    top = graph.champion_set(bans.top_banned(_ban_count(spark, d)))
    return graph.banned_subgraph(_graph(spark, d, both_sides), top), top


# ---- normalisation -----------------------------------------------------------------

def normalize_match_event(spark, d):
    return normalize.match_events(_t(spark, d))


def normalize_bans(spark, d):
    return normalize.match_bans(_t(spark, d))


def normalize_edges(spark, d):
    return _edges(spark, d)


def normalize_edges_skew_safe(spark, d):
    """The edges again: every plan is the one that never gathers a match in one task."""
    return normalize.match_edges(_t(spark, d))


def _match_store(spark, d) -> match_store.MatchStore:
    """The matches of the tables, loaded into buckets."""
    store = match_store.open_store(spark, scratch_path(spark, "match-store"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.add(_t(spark, d))
    return store


def match_store_edges(spark, d):
    """The edges read from bucketed match tables: no shuffle after the load."""
    return _match_store(spark, d).edges()


def match_store_events(spark, d):
    """Nested events from bucketed match tables, serialised, parsed and flattened again."""
    good, _ = documents.split_quarantine(documents.parse_events(normalize.to_records(_match_store(spark, d).events())))
    return documents.event_edges(good)


def multi_tracked_edges(spark, d):
    """Every known tracked participant of a match is tracked, so a match fans out over several players."""
    t = _t(spark, d)
    tracked = t.players.filter("tracked").select("player_key")
    listed = t.participants.join(tracked, "player_key", "left_semi").select("player_key", "match_id").distinct()
    return normalize.match_edges(replace(t, match_list=listed))


def nested_event_roundtrip(spark, d):
    """Nest edges into events, serialise to the topic format, parse, flatten."""
    recs = normalize.to_records(normalize.event_documents(_t(spark, d)))
    good, _ = documents.split_quarantine(documents.parse_events(recs))
    return documents.event_edges(good)


def raw_document_edges(spark, d):
    """Matches landed as match-API JSON documents, read with the document
    schema, flattened (identity lookup inside each document) and normalised."""
    t = _t(spark, d)
    path = scratch_path(spark, "raw-matches")
    # identities are listed in an order of their own: the last one of a name is not the highest id
    ids = F.transform("participantIdentities", lambda i: F.struct((i["participantId"] % 3).alias("o"), i.alias("i")))
    (documents.to_raw_documents(t)
     .withColumn("participantIdentities", F.transform(F.array_sort(ids), lambda x: x["i"]))
     .write.mode("overwrite").json(path))
    docs = documents.read_raw_matches(spark, path)
    flat = documents.flatten_raw_matches(docs, t.champions, t.players, tables.match_list(spark, d))
    return normalize.match_edges(flat)


def raw_document_quarantine(spark, d):
    """Every match landed three times: whole, cut off in the middle, and without its teams."""
    docs = documents.to_raw_documents(_t(spark, d))
    path = scratch_path(spark, "raw-variants")
    whole = F.to_json(F.struct(*docs.columns))
    teamless = F.to_json(F.struct(*[c for c in docs.columns if c != "teams"]))
    texts = F.array(whole, F.expr("substr(w, 1, length(w) div 2)"), teamless)
    docs.withColumn("w", whole).select(F.explode(texts).alias("value")).write.mode("overwrite").text(path)
    good, bad = documents.split_raw_matches(documents.read_raw_matches(spark, path))
    seen = good.select(F.col("gameId").alias("match_id"), F.size("participants").cast("bigint").alias("n_participants"),
                       F.lit(False).alias("quarantined"), F.lit(False).alias("corrupt"))
    return seen.unionByName(bad.select(
        F.when(F.col(documents.CORRUPT).isNull(), F.col("gameId")).otherwise(-1).alias("match_id"), F.lit(0).cast("bigint").alias("n_participants"),
        F.lit(True).alias("quarantined"), F.col(documents.CORRUPT).isNotNull().alias("corrupt")))


def json_root_variants(spark, d):
    """Each event as an object root, an array root, broken text, without a
    required key, without a key of its edges, with a time that is none and
    with a duration beyond BIGINT; parsed with quarantine.  Quarantined records
    carry no parsed values (duration -1, null winner, zero elements)."""
    docs = normalize.event_documents(_t(spark, d))
    ts = F.col("ts").cast("string").alias("ts")
    whole = F.to_json(F.struct("match_id", ts, "gameDuration", "winner", "bans", "edges"))
    no_dur = F.to_json(F.struct("match_id", ts, "winner", "bans", "edges"))
    bad_ts = F.to_json(F.struct("match_id", F.lit("not a time").alias("ts"), "gameDuration", "winner", "bans", "edges"))
    huge = F.to_json(F.struct("match_id", ts, F.lit(1e30).alias("gameDuration"), "winner", "bans", "edges"))
    v = docs.select("match_id", "my_id", whole.alias("value"), no_dur.alias("no_dur"), bad_ts.alias("bad_ts"), huge.alias("huge"))
    variants = F.array(
        F.struct(F.lit("object").alias("variant"), F.col("value").alias("text")),
        F.struct(F.lit("array").alias("variant"), F.concat(F.lit("["), "value", F.lit("]")).alias("text")),
        F.struct(F.lit("corrupt").alias("variant"), F.concat(F.lit("oops"), "value").alias("text")),
        F.struct(F.lit("missing_key").alias("variant"), F.col("no_dur").alias("text")),
        F.struct(F.lit("missing_edge_key").alias("variant"),
                 F.replace("value", F.lit('"outcome":'), F.lit('"result":')).alias("text")),
        F.struct(F.lit("bad_ts").alias("variant"), F.col("bad_ts").alias("text")),
        F.struct(F.lit("huge_duration").alias("variant"), F.col("huge").alias("text")))
    recs = v.select("match_id", "my_id", F.explode(variants).alias("r")).select(
        "match_id", "my_id", "r.variant", F.col("r.text").alias("value"))
    p = documents.parse_events(recs)
    ok = ~F.col("quarantined")
    return p.select(
        "match_id", "my_id", "variant", "quarantined", "reason",
        F.when(ok, F.col("_event.gameDuration").try_cast("bigint")).otherwise(-1).alias("game_duration"),
        F.when(ok, F.col("_event.winner")).alias("winner"),
        F.when(ok, F.size("_event.bans")).otherwise(0).cast("bigint").alias("n_bans"),
        F.when(ok, F.size("_event.edges")).otherwise(0).cast("bigint").alias("n_edges"))


def event_unknown_fields(spark, d):
    """Events with fields that the schema does not know: kept as VARIANT beside the typed fields and read back from it."""
    docs = normalize.event_documents(_t(spark, d))
    more = F.struct(F.col("match_id").alias("patch"), F.lit("x").alias("region"))
    recs = docs.select("key", F.to_json(F.struct("match_id", "gameDuration", "winner", "bans", "edges", more.alias("extra"))).alias("value"))
    whole = documents.with_payload(recs)
    good, _ = documents.split_quarantine(documents.parse_events(whole))
    back = documents.with_payload(good.withColumn("text", F.to_json("payload")), "text", "again")  # a round trip of the variant
    field = lambda c, path, kind: F.try_variant_get(c, path, kind)
    return back.select("match_id", "winner", field("again", "$.extra.patch", "bigint").alias("patch"),
                       field("again", "$.extra.region", "string").alias("region"), F.size("bans").cast("bigint").alias("n_bans"))


def match_list_slice(spark, d):
    ev = tables.read_table(spark, d, "events")
    begin = ev.agg(F.min("ts")).scalar()
    return matchlist.match_list_slices(ev, begin)


def match_list_slice_queue(spark, d):
    """The slices of one queue only."""
    ev = tables.read_table(spark, d, "events")
    begin = ev.agg(F.min("ts")).scalar()
    return matchlist.match_list_slices(ev, begin, queue="click")


def match_list_documents(spark, d):
    """Match-list pages (one per player and poll) landed as JSON, read back and
    cut at endIndex, which leaves out the last game of a longer page."""
    ev = tables.read_table(spark, d, "events")
    slices = matchlist.match_list_slices(ev, ev.agg(F.min("ts")).scalar())
    game = F.struct("idx", F.col("game_id").alias("gameId"), F.lit(420).alias("queue"),
                    F.floor(colfn.ntz_to_epoch_micros("ts") / 1000).alias("timestamp"))
    pages = slices.groupBy("player", "poll").agg(  # a page is one poll of one player
        F.array_sort(F.collect_list(game)).alias("games"), F.max("end_index").alias("n"))
    path = scratch_path(spark, "match-lists")
    pages.select(F.col("player").cast("string").alias("accountId"),
                 F.greatest(F.col("n") - 1, F.lit(1)).cast("int").alias("endIndex"),
                 F.transform("games", lambda g: F.struct(g["gameId"].alias("gameId"), g["queue"].alias("queue"),
                                                         g["timestamp"].alias("timestamp"))).alias("matches")
                 ).write.mode("overwrite").json(path)
    return documents.explode_match_lists(documents.read_match_lists(spark, path))


def poll_increment(spark, d):
    """One incremental poll: some players have a mark from earlier, others start at the first event."""
    ev = tables.read_table(spark, d, "events")
    games = ev.select(F.col("user_id").alias("player"), F.col("event_id").alias("game_id"), "ts")
    cursor = (games.filter((F.col("game_id") % 2 == 0) & (F.col("player") % 3 != 0))
              .groupBy("player").agg(F.max("ts").alias("last_ts")))
    begin = ev.agg(F.min("ts")).scalar()
    new, _ = matchlist.poll_increment(games, cursor, begin)
    return new.select("player", "game_id", "ts")


def roster_documents(spark, d):
    """League pages and account documents landed as JSON (names hold blanks), read back and resolved."""
    cust = tables.read_table(spark, d, "customer").select(
        F.replace("c_name", F.lit("#"), F.lit(" ")).alias("name"), "c_custkey")
    root = scratch_path(spark, "roster")
    entry = F.struct(F.col("name").alias("summonerName"))
    (cust.groupBy(F.expr("c_custkey div 100").alias("page")).agg(F.collect_list(entry).alias("entries"))
     .select(F.to_json("entries").alias("value")).write.mode("overwrite").text(f"{root}/league"))
    (cust.select("name", F.col("c_custkey").cast("string").alias("accountId"))
     .write.mode("overwrite").json(f"{root}/accounts"))
    names = matchlist.roster(documents.read_league_entries(spark, f"{root}/league"), order=[F.asc("summoner_name")])
    return matchlist.resolve_accounts(names, documents.read_accounts(spark, f"{root}/accounts"))


def roster_accounts(spark, d):
    cust = tables.read_table(spark, d, "customer")
    entries = cust.select(F.col("c_name").alias("summoner_name"), F.col("c_acctbal").alias("rating"))
    accounts = cust.select(F.col("c_name").alias("summoner_name"), F.col("c_custkey").alias("account_id"))
    return matchlist.resolve_accounts(matchlist.roster(entries), accounts)


def champion_dimension(spark, d):
    """Champion list written as headerless ``id,name`` text and read back."""
    path = scratch_path(spark, "champions")
    documents.write_champion_csv(tables.champions(spark, d), path)
    return documents.read_champion_csv(spark, path)


# ---- edges, vertices, columns --------------------------------------------------------

def oriented_edges(spark, d):
    return graph.oriented_edges(_edges(spark, d))


def vertex_extract(spark, d):
    return graph.extract_vertices(_edges(spark, d))


def edge_csv_line(spark, d):
    me = _edges(spark, d).withColumn("win", F.col("outcome") != "Fail")
    return me.select("match_id", "participant_id", colfn.edge_csv_line().alias("line"))


def edge_attr_map(spark, d):
    return graph.edge_attributes(graph.oriented_edges(_edges(spark, d)))


def player_id_hash(spark, d):
    """Reference-compatible 32-bit name ids (Scala MurmurHash3) for every player."""
    p = tables.players(spark, d)
    return p.select("player_key", "player_name", name_id("player_name", "murmur3").alias("murmur3_id"))


# ---- bans -------------------------------------------------------------------------------

def ban_counts(spark, d):
    return _ban_count(spark, d)


def ban_running_count(spark, d):
    return bans.running_ban_count(materialize(normalize.match_bans(_t(spark, d)), "match-bans"))


def _publish_events(spark, d, path: str) -> None:
    """Write match events as JSON (key, value) records: the topic stand-in."""
    recs = normalize.to_records(normalize.event_documents(_t(spark, d)))
    recs.write.mode("overwrite").json(path)


def _topic(spark, path: str, **per_core) -> DataFrame:
    return documents.json_record_stream(spark, path, max_bytes_per_trigger=trigger_bytes(spark, **per_core))


def ban_counts_stream(spark, d):
    """Events published to files, consumed by the streaming ban counter."""
    root = scratch_path(spark, "ban-stream")
    _publish_events(spark, d, f"{root}/topic")
    store = UpsertStore(spark, f"{root}/ban_count", ["champion"], schemas.BAN_COUNT).create().truncate()
    q = jobs.start_ban_counts(_topic(spark, f"{root}/topic"), store,
                              f"{root}/checkpoint", trigger={"availableNow": True})
    jobs.run_available(q)
    return store.read()


def top_banned(spark, d):
    return bans.top_banned(_ban_count(spark, d))


def top_banned_chart(spark, d):
    return marts.top_bans_chart(_ban_count(spark, d))


# ---- statistics --------------------------------------------------------------------------

def stats_sliding(spark, d):
    return stats.sliding_stats(tables.events(spark, d))


def stats_sliding_stream(spark, d):
    """The events table consumed as a file stream by the windowed job."""
    root = scratch_path(spark, "stats-stream")
    ev = tables.read_table(spark, d, "events")
    # the pattern fits a single file as well as a folder of part files
    src = (spark.readStream.schema(ev.schema).option("maxBytesPerTrigger", trigger_bytes(spark))
           .parquet(f"{d.rstrip('/')}/events.parquet*"))
    matches = tables.events_as_matches(src)
    store = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create().truncate()
    q = jobs.start_sliding_stats(matches, store, f"{root}/checkpoint", trigger={"availableNow": True})
    jobs.run_available(q)
    return store.read()


def stats_panes_stream(spark, d):
    """The events in shuffled order over several micro-batches, summed up by panes; windows slide over the panes."""
    root = scratch_path(spark, "stats-panes")
    ev = tables.events_as_matches(tables.read_table(spark, d, "events"))
    ev.repartition(4, F.xxhash64("ts")).write.parquet(f"{root}/events")
    matches = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/events")
    panes, store = (UpsertStore(spark, f"{root}/{n}", ["slot"], schemas.MATCH_STATS).create() for n in ("panes", "stats"))
    jobs.run_available(jobs.start_pane_stats(matches, panes, store, f"{root}/checkpoint", trigger={"availableNow": True}))
    return store.read()


def stats_upsert(spark, d):
    """Three partial-column upserts of one stats row per slot, merged on read."""
    root = scratch_path(spark, "stats-upsert")
    st = stats.sliding_stats(tables.events(spark, d))
    store = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create().truncate()
    for part, col in enumerate(("duration", "red_win", "tot_matches")):
        store.upsert(st.select("slot", col), batch_id=0, part=part)
    return store.read()


# ---- graph ----------------------------------------------------------------------------------

def graph_vertices(spark, d):
    return _graph(spark, d, both_sides=False).vertices


def graph_stats(spark, d):
    return graph.graph_stats(_graph(spark, d, both_sides=False))


def banned_subgraph(spark, d):
    return _banned(spark, d, both_sides=False)[0].edges


def graph_degrees(spark, d):
    return graph.with_degrees(_banned(spark, d)[0])


def tracked_players_vs_banned(spark, d):
    return graph.tracked_with_edges(_banned(spark, d)[0])


def pattern_match_hop(spark, d):
    g, top = _banned(spark, d)
    return graph.pattern_hop(g, top)


def pattern_match_hop_heavy(spark, d):
    """The hop again, hub players found by a sketch and joined without a shuffle."""
    g, top = _banned(spark, d)
    kept = graph.PropertyGraph(vertices=g.vertices, edges=materialize(g.edges, "banned-edges"))
    return graph.pattern_hop(kept, top, heavy_share=0.01)


def graph_export_nodes(spark, d):
    """Graph store load: overwrite (delete all) then write merged USER nodes."""
    path = scratch_path(spark, "export") + "/nodes"
    g, _ = _banned(spark, d, both_sides=False)
    graph.export_nodes(g).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def graph_export_rels(spark, d):
    path = scratch_path(spark, "export") + "/rels"
    g, _ = _banned(spark, d, both_sides=False)
    graph.export_relationships(g).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def edges_csv_roundtrip(spark, d):
    path = scratch_path(spark, "edges-csv")
    graph_files.write_graph_file(graph.oriented_edges(_edges(spark, d)), path, "csv", skip_empty=True)
    return graph_files.read_edges(spark, path, "csv")


def vertices_csv_roundtrip(spark, d):
    path = scratch_path(spark, "vertices-csv")
    graph_files.write_graph_file(graph.extract_vertices(_edges(spark, d)), path, "csv")
    return graph_files.read_vertices(spark, path, "csv")


# ---- the streaming job and the graph job over its files ----------------------------------------

def _streamed(spark, d) -> str:
    """Run the whole streaming job over the published events; returns its root folder."""
    root = scratch_path(spark, "match-jobs")
    _publish_events(spark, d, f"{root}/topic")
    queries = jobs.start_match_jobs(_topic(spark, f"{root}/topic"), f"{root}/out", trigger={"availableNow": True},
                                    id_mode="murmur3")
    for q in queries.values():
        jobs.run_available(q)
    return f"{root}/out"


def stream_edges_name_id(spark, d):
    """Edge files of the streaming job, players identified by the hash of their names."""
    return graph_files.read_edges(spark, f"{_streamed(spark, d)}/edges")


def stream_vertices_name_id(spark, d):
    return graph_files.read_vertices(spark, f"{_streamed(spark, d)}/vertices").distinct()


def stream_running_bans(spark, d):
    """Per-ban running totals of the streaming job, summed up per champion."""
    run = spark.read.parquet(f"{_streamed(spark, d)}/running")
    return run.groupBy("champion").agg(F.count("*").alias("n"), F.min("running").alias("first"),
                                       F.max("running").alias("last"), F.countDistinct("running").alias("steps"))


def running_bans_state(spark, d):
    """Running totals in operator state over events without match ids, a third of all bans on one champion."""
    root = scratch_path(spark, "running-state")
    docs = normalize.event_documents(_t(spark, d))
    hot = F.transform("bans", lambda b, i: F.when((F.col("match_id") + i) % 3 == 0, F.lit("HOT")).otherwise(b))
    docs = docs.withColumn("bans", hot).withColumn("match_id", F.lit(None).cast("bigint"))
    normalize.to_records(docs).repartition(4).write.json(f"{root}/topic")
    topic = documents.json_record_stream(spark, f"{root}/topic", max_files_per_trigger=2)
    jobs.run_available(jobs.start_running_bans(topic, f"{root}/running", f"{root}/checkpoint", {"availableNow": True}))
    run = spark.read.parquet(f"{root}/running")
    return run.groupBy("champion").agg(F.count("*").alias("n"), F.min("running").alias("first"),
                                       F.max("running").alias("last"), F.countDistinct("running").alias("steps"))


def stream_ingest_graph(spark, d):
    """Landed match documents to topic to tables to the graph job, all as streams; every fifth document is cut off and rejected."""
    root = scratch_path(spark, "ingest")
    t = _t(spark, d)
    docs = documents.to_raw_documents(t)
    text = F.col("text")
    cut = F.when(F.col("gameId") % 5 == 0, F.array(text, F.left(text, F.length(text) / 2))).otherwise(F.array(text))
    dimensions = lambda: (tables.champions(spark, d), tables.players(spark, d), tables.match_list(spark, d))
    now = {"availableNow": True}
    with clean_shuffles(spark):
        (docs.select("gameId", F.to_json(F.struct(*docs.columns)).alias("text")).select(F.explode(cut).alias("value"))
         .write.option("compression", "gzip").text(f"{root}/landed"))
        raw = documents.read_raw_matches(spark, f"{root}/landed", streaming=True, max_bytes_per_trigger=trigger_bytes(spark, GZIP_PER_CORE))
        jobs.run_available(jobs.start_normalisation(raw, dimensions, jobs.publish_files(f"{root}/topic"), f"{root}/rejected", f"{root}/checkpoint", now))
        live = GraphTables(spark, f"{root}/graph", keep=2)
        for q in jobs.start_match_jobs(_topic(spark, f"{root}/topic", per_core=GZIP_PER_CORE), f"{root}/out", trigger=now, id_mode="murmur3",
                                       graph_tables=live).values():
            jobs.run_available(q)
    return live.job(UpsertStore(spark, f"{root}/out/ban_count", ["champion"], schemas.BAN_COUNT).read())


def match_list_arrivals(spark, d):
    """List entries and matches as two streams: a third of the matches lands before the lists, a third after, a third never."""
    root = scratch_path(spark, "arrivals")
    t = _t(spark, d)
    docs = documents.to_raw_documents(t)
    lists = tables.match_list(spark, d).select(F.col("player_key").cast("string").alias("account_id"), F.col("match_id").alias("game_id"))
    for folder in ("docs", "lists"):  # the streams need their folders to exist
        (docs if folder == "docs" else lists).limit(0).write.json(f"{root}/{folder}/none")
    store = jobs.arrivals_store(spark, f"{root}/arrivals")

    def run():
        listed = spark.readStream.schema(lists.schema).option("recursiveFileLookup", "true").json(f"{root}/lists")
        landed = documents.read_raw_matches(spark, f"{root}/docs/*", streaming=True).select(F.col("gameId").alias("game_id"))
        jobs.run_available(jobs.start_list_arrivals(listed, landed, store, f"{root}/checkpoint", {"availableNow": True}))

    docs.filter("gameId % 3 = 0").write.json(f"{root}/docs/before")
    lists.write.json(f"{root}/lists/all")
    run()
    docs.filter("gameId % 3 = 1").write.json(f"{root}/docs/after")
    run()
    return store.read("arrivals")


def poll_store(spark, d):
    """Two polls into one store, the second over all games again: a game is taken once, games and marks are committed together."""
    ev = tables.read_table(spark, d, "events")
    games = ev.select(F.col("user_id").alias("player"), F.col("event_id").alias("game_id"), "ts")
    store = matchlist.PollStore(spark, scratch_path(spark, "polls"))
    bounds = ev.agg(F.min("ts").alias("low"), F.timestamp_micros(F.expr("bigint((min(unix_micros(cast(ts as timestamp))) + max(unix_micros(cast(ts as timestamp)))) / 2)"))
                    .cast("timestamp_ntz").alias("middle")).first()
    begin = F.lit(bounds.low).cast("timestamp_ntz")
    store.poll(games.filter(F.col("ts") <= F.lit(bounds.middle).cast("timestamp_ntz")), begin)
    store.poll(games, begin)
    marks = store.cursor()
    return store.games().join(marks, "player").groupBy("player").agg(
        F.count("*").alias("games"), F.countDistinct("game_id").alias("distinct_games"), F.max("last_ts").alias("last_ts"))


def graph_export_merged(spark, d):
    """Two loads of the graph store: the second merges into the first and keeps its nodes and relationships."""
    g, _ = _banned(spark, d, both_sides=False)
    v, e = materialize(g.vertices, "export-vertices"), materialize(g.edges, "export-edges")
    store = ExportStore(spark, scratch_path(spark, "graph-store"))
    for part in ("id % 3 <> 0", "id % 2 = 0"):  # the loads overlap, and together hold all but some
        own = e.withColumn("id", F.col("src_id"))
        store.load(graph.PropertyGraph(vertices=v.filter(part), edges=own.filter(part).drop("id")))
    rels = store.read("rels").groupBy("src_id").agg(F.count("*").alias("n"))
    return store.read("nodes").join(rels, F.col("id") == F.col("src_id"), "left").select("id", "name", F.coalesce("n", F.lit(0)).alias("n_rels"))


def edges_folded(spark, d):
    """Edges appended in many small batches and folded into one folder."""
    store = GraphTables(spark, scratch_path(spark, "folded"), buckets=8)
    e = materialize(_edges(spark, d), "fold-edges")
    for batch in range(3):
        store.merge({"edges": graph.oriented_edges(e.filter(F.pmod("match_id", F.lit(3)) == batch))}, batch)
    store.fold("edges", at_least=2)
    return store.read("edges")


def graph_job_files(spark, d):
    """Stream -> files -> graph job: tracked players against the most banned champions, name ids."""
    out = _streamed(spark, d)
    ban_table = UpsertStore(spark, f"{out}/ban_count", ["champion"], schemas.BAN_COUNT).read()
    return graph.graph_job(spark, f"{out}/edges", f"{out}/vertices", ban_table, export_path=f"{out}/graph")


# ---- marts -----------------------------------------------------------------------------------

def mart_avg_length(spark, d):
    return marts.avg_length(normalize.match_events(_t(spark, d)))


def mart_win_share(spark, d):
    return marts.win_share(normalize.match_events(_t(spark, d)))


def mart_avg_length_slots(spark, d):
    """Dashboard parity: totals summed over the rows of the stats table."""
    return marts.avg_length(stats.sliding_stats(tables.events(spark, d)), source="slots")


def mart_win_share_slots(spark, d):
    return marts.win_share(stats.sliding_stats(tables.events(spark, d)), source="slots")


REGISTRY: dict[str, Query] = {
    "normalize_match_event": normalize_match_event,
    "normalize_bans": normalize_bans,
    "normalize_edges": normalize_edges,
    "normalize_edges_skew_safe": normalize_edges_skew_safe,
    "match_store_edges": match_store_edges,
    "match_store_events": match_store_events,
    "multi_tracked_edges": multi_tracked_edges,
    "nested_event_roundtrip": nested_event_roundtrip,
    "raw_document_edges": raw_document_edges,
    "raw_document_quarantine": raw_document_quarantine,
    "json_root_variants": json_root_variants,
    "event_unknown_fields": event_unknown_fields,
    "match_list_slice": match_list_slice,
    "match_list_slice_queue": match_list_slice_queue,
    "match_list_documents": match_list_documents,
    "poll_increment": poll_increment,
    "roster_accounts": roster_accounts,
    "roster_documents": roster_documents,
    "champion_dimension": champion_dimension,
    "oriented_edges": oriented_edges,
    "vertex_extract": vertex_extract,
    "edge_csv_line": edge_csv_line,
    "edge_attr_map": edge_attr_map,
    "player_id_hash": player_id_hash,
    "ban_counts": ban_counts,
    "ban_running_count": ban_running_count,
    "ban_counts_stream": ban_counts_stream,
    "top_banned": top_banned,
    "top_banned_chart": top_banned_chart,
    "stats_sliding": stats_sliding,
    "stats_sliding_stream": stats_sliding_stream,
    "stats_upsert": stats_upsert,
    "graph_vertices": graph_vertices,
    "graph_stats": graph_stats,
    "banned_subgraph": banned_subgraph,
    "graph_degrees": graph_degrees,
    "tracked_players_vs_banned": tracked_players_vs_banned,
    "pattern_match_hop": pattern_match_hop,
    "pattern_match_hop_heavy": pattern_match_hop_heavy,
    "graph_export_nodes": graph_export_nodes,
    "graph_export_rels": graph_export_rels,
    "stream_edges_name_id": stream_edges_name_id,
    "stream_vertices_name_id": stream_vertices_name_id,
    "stream_running_bans": stream_running_bans,
    "graph_job_files": graph_job_files,
    "stats_panes_stream": stats_panes_stream,
    "running_bans_state": running_bans_state,
    "stream_ingest_graph": stream_ingest_graph,
    "match_list_arrivals": match_list_arrivals,
    "poll_store": poll_store,
    "graph_export_merged": graph_export_merged,
    "edges_folded": edges_folded,
    "edges_csv_roundtrip": edges_csv_roundtrip,
    "vertices_csv_roundtrip": vertices_csv_roundtrip,
    "mart_avg_length": mart_avg_length,
    "mart_win_share": mart_win_share,
    "mart_avg_length_slots": mart_avg_length_slots,
    "mart_win_share_slots": mart_win_share_slots,
}
