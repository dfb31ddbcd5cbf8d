"""Structured Streaming jobs over the match-event topic.

Source: (key, value) records, from Kafka or from JSON files (same contract).
Outputs, as in the reference streaming job:

* sliding 30/5-minute statistics -> upsert table keyed by slot (windowed
  aggregation on event or arrival time; nothing is late unless a watermark
  is set);
* edges and vertices appended per micro-batch (edges skipped when empty);
* per-ban running totals (one output row per ban, as the stateful map of the
  reference emits) and the champions' totals, computed in ``foreachBatch``
  from the batch plus the totals committed by earlier batches, which keeps
  them exact and idempotent; a hot champion is split by the range-partitioned row
  number.  ``start_running_bans`` is the same with the totals in operator state;
* malformed records go to a quarantine folder instead of failing the query.

``start_normalisation`` stands in front: landed match documents in, records of the topic out.
``start_pane_stats`` keeps 5-minute panes as state and slides windows over them, and
``start_list_arrivals`` matches list entries with the documents that arrive for them.

``start_match_jobs`` runs the statistics query plus one sink that does all of
the rest off a single parse of each micro-batch.  ``start_ban_counts`` is the
alternative ban table: Spark's stateful ``groupBy.count`` in update mode
(partial counts merged map-side before the state store).

Every sink write is keyed by batch id (partition overwrite or a batch-id
folder), so a micro-batch replayed after executor or driver loss rewrites the
same data; checkpoints live in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions.columns import epoch_micros_to_ntz, ntz_as_instant
from ..functions.ranking import range_row_number
from ..operators import graph, normalize, stats
from ..operators.bans import running_ban_count
from ..operators.stats import SLIDE_MINUTES, WINDOW_MINUTES, sliding_stats_streaming
from ..sources.documents import (CORRUPT, event_bans, event_edges, flatten_raw_matches, parse_events, raw_reject_reason, split_quarantine,
                                 split_raw_matches)
from ..sources.graph_files import write_graph_file
from . import state
from .graph_tables import GraphTables
from .store import UpsertStore
from .versions import BucketStore, Keyed

# Fixed value: micro-batch interval of the reference job.
BATCH_INTERVAL = "5 minutes"

# Players of events are identified by their names, as in the reference: the ids in an event are opaque
# strings, and the tracked player's (an account id) never equals an opponent's (a summoner id).
EVENT_ID_MODE = "xxhash64"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"processingTime": BATCH_INTERVAL}))


def ban_counts_stream(records: DataFrame) -> DataFrame:
    """Streaming (champion, ban_count) over all good events."""
    good, _ = split_quarantine(parse_events(records))
    return event_bans(good).groupBy("champion").agg(F.count(F.lit(1)).alias("ban_count"))


def start_ban_counts(records: DataFrame, store: UpsertStore, checkpoint: str,
                     trigger: dict | None = None) -> StreamingQuery:
    """Running ban totals upserted into ``store`` (key: champion) each batch."""
    counts = ban_counts_stream(records)
    w = (counts.writeStream.outputMode("update")
         .foreachBatch(store.upsert)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_sliding_stats(matches: DataFrame, store: UpsertStore, checkpoint: str,
                        watermark: str | None = None, trigger: dict | None = None,
                        window_minutes: int = WINDOW_MINUTES,
                        slide_minutes: int = SLIDE_MINUTES,
                        time_basis: str = "event", dedupe_key: str | None = None) -> StreamingQuery:
    """Windowed statistics upserted into ``store`` (key: slot).

    ``matches`` is a streaming frame with ts (TIMESTAMP or TIMESTAMP_NTZ),
    game_duration and winner.  Slots are stored as TIMESTAMP_NTZ (UTC).

    ``time_basis="event"`` windows matches by their own time; ``"arrival"``
    windows them by the micro-batch clock, as the reference's processing-time
    window does (a match then counts in the six slots after its arrival).  A
    match without a time of its own is windowed by its arrival.

    Without a watermark (the default) nothing is ever late: the state keeps
    one row per slot (105 120 a year).  A ``watermark`` bounds the state, and
    Spark then drops what arrives later than that, counted in the query's
    progress as ``numRowsDroppedByWatermark``.  ``dedupe_key`` counts a match
    reported several times once: within the watermark if there is one, else
    for good, which keeps every key in the state.
    """
    m = _timed(matches, time_basis)
    if watermark:
        m = m.withWatermark("ts", watermark)
    slots = sliding_stats_streaming(m, window_minutes, slide_minutes, dedupe_key, bool(watermark)).withColumn(
        "slot", epoch_micros_to_ntz(F.unix_micros("slot")))
    w = (slots.writeStream.outputMode("update")
         .foreachBatch(store.upsert)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def _timed(matches: DataFrame, time_basis: str) -> DataFrame:
    """``ts`` as an instant: the match's own time, or its arrival where it has none or ``time_basis`` is "arrival"."""
    if time_basis == "arrival":
        return matches.withColumn("ts", F.current_timestamp())
    if time_basis != "event":
        raise ValueError(f"unknown time basis {time_basis!r}")
    # Watermarks need an instant: TIMESTAMP_NTZ is read as UTC, and slots go back to NTZ the
    # same way, so neither direction depends on the session time zone.
    ts = ntz_as_instant("ts") if dict(matches.dtypes)["ts"] == "timestamp_ntz" else F.col("ts")
    return matches.withColumn("ts", F.coalesce(ts, F.current_timestamp()))


def start_pane_stats(matches: DataFrame, panes: UpsertStore, store: UpsertStore, checkpoint: str, trigger: dict | None = None,
                     window_minutes: int = WINDOW_MINUTES, slide_minutes: int = SLIDE_MINUTES, time_basis: str = "event",
                     dedupe_key: str | None = None) -> StreamingQuery:
    """Windowed statistics by panes: same table as ``start_sliding_stats`` without its fan-out.

    The stream sums matches up per 5-minute pane, one state row and one update per pane, and only the panes that a
    micro-batch changed are fanned out to the windows over them.  ``panes`` (key: slot, the pane's start) keeps the panes; a
    changed window is summed up from them anew, so a late match amends its pane and the windows over it, however late it is.
    """
    if window_minutes % slide_minutes:
        raise ValueError("window length must be a multiple of the slide")
    m = _timed(matches, time_basis)
    if dedupe_key:
        m = stats.distinct_matches(m, dedupe_key)
    counted = stats.panes(m, slide_minutes).withColumn("pane", epoch_micros_to_ntz(F.unix_micros("pane")))

    def sink(batch: DataFrame, batch_id: int) -> None:
        changed = batch.withColumnRenamed("pane", "slot").persist()
        try:
            panes.upsert(changed, batch_id)
            slots = changed.select(stats.slots_of("slot", window_minutes, slide_minutes).alias("slot")).distinct()
            known = panes.read(before_batch=batch_id + 1).withColumnRenamed("slot", "pane")
            store.upsert(stats.slide_panes(known, window_minutes, slide_minutes).join(slots, "slot", "left_semi"), batch_id)
        finally:
            changed.unpersist()

    w = counted.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_running_bans(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Per-ban running totals with the champions' totals in operator state.

    The state of a champion is one number; it receives one partial count per task and gives back the total before the batch.  The
    bans themselves never pass through the state: the batch numbers them by range partitions and adds the prior total, so
    a champion with a third of all bans is spread over tasks, whether or not events carry match ids.  Output: (match_id, pos, champion,
    running), one folder per batch below ``path``, overwritten by a replay of the batch.
    """
    good, _ = split_quarantine(parse_events(records))
    bans = event_bans(good)
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    both = bans.select("match_id", "pos", "champion", none("prior", "bigint")).unionByName(
        state.prior_totals(bans).select(none("match_id", "bigint"), none("pos", "int"), "champion", "prior"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            prior = batch.filter("prior is not null").select(F.col("champion").alias("__champion"), "prior")
            ranked = range_row_number(batch.filter("prior is null").drop("prior"), ["champion"], ["match_id", "pos"], "rn")
            (ranked.join(prior, F.col("champion").eqNullSafe(F.col("__champion")))
             .select("match_id", "pos", "champion", (F.col("rn") + F.col("prior")).alias("running"))
             .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    with state.rocksdb(records.sparkSession):
        w = both.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", checkpoint)
        return _trigger(w, trigger).start()


def start_normalisation(docs: DataFrame, dimensions: Callable[[], tuple[DataFrame, DataFrame, DataFrame]],
                        publish: Callable[[DataFrame, int], None], rejected_path: str, checkpoint: str,
                        trigger: dict | None = None) -> StreamingQuery:
    """Landed match documents (``read_raw_matches(streaming=True)``) to records of the topic, as they arrive.

    ``dimensions`` gives (champions, players, match list) and is asked anew for every micro-batch, so that a new
    champion or tracked player counts from the next batch on.  ``publish`` writes the (key, value) records of a batch; it gets the
    batch id to overwrite what an earlier attempt left (``publish_files`` for files, ``write_kafka`` for a topic that tolerates repeats).
    Rejected documents go to ``rejected_path`` with a reason, one folder per batch.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            _, bad = split_raw_matches(batch)
            bad.withColumn("reason", raw_reject_reason(CORRUPT in batch.columns)).write.mode("overwrite").parquet(f"{rejected_path}/batch_id={batch_id}")
            publish(normalize.to_records(normalize.event_documents(flatten_raw_matches(batch, *dimensions()))), batch_id)
        finally:
            batch.unpersist()

    w = docs.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def publish_files(path: str) -> Callable[[DataFrame, int], None]:
    """Publisher of ``start_normalisation`` that writes gzipped JSON records, one folder per batch (read by ``json_record_stream``)."""
    return lambda records, batch_id: records.write.mode("overwrite").option("compression", "gzip").json(f"{path}/batch-{batch_id:010d}")


#: State of a match-list entry: "matched" once its match is there ("matched" < "pending", so the minimum keeps it).
ARRIVALS = Keyed("account_id STRING, game_id BIGINT, status STRING", ("account_id", "game_id"), {"status": F.min})


def arrivals_store(spark, root: str, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, root, {"arrivals": ARRIVALS}, buckets)


def start_list_arrivals(lists: DataFrame, matches: DataFrame, store: BucketStore, checkpoint: str, trigger: dict | None = None,
                        ttl_ms: int | None = None) -> StreamingQuery:
    """Two streams, list entries (account_id, game_id) and matches (game_id), into ``store`` (``arrivals_store``).

    Entries without their match stay there as pending: what a poller has to fetch (again).
    """
    out = state.list_arrivals(lists, matches, ttl_ms)
    with state.rocksdb(lists.sparkSession):
        w = (out.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: store.merge({"arrivals": batch}, batch_id))
             .option("checkpointLocation", checkpoint))
        return _trigger(w, trigger).start()


class MatchEventSink:
    """One ``foreachBatch`` handler fanning a parsed batch out to several outputs.

    The parsed batch is persisted once and reused by every output, like the
    six output operations the reference hangs off one parsed stream.  Only
    rejected records keep their text there, and the edges keep the players' ids.
    """

    def __init__(self, edges_path: str, vertices_path: str, running_path: str,
                 quarantine_path: str, totals: UpsertStore, fmt: str = "parquet",
                 id_mode: str = EVENT_ID_MODE, graph_tables: GraphTables | None = None):
        self.graph_tables = graph_tables
        self.edges_path, self.vertices_path = edges_path, vertices_path
        self.running_path, self.quarantine_path = running_path, quarantine_path
        self.totals, self.fmt, self.id_mode = totals, fmt, id_mode

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        parsed = parse_events(batch)
        parsed = parsed.withColumn("value", F.when(F.col("quarantined"), F.col("value"))).persist()
        try:
            good, bad = split_quarantine(parsed)
            bad.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(
                f"{self.quarantine_path}/batch_id={batch_id}")
            edges = graph.with_ids(event_edges(good), self.id_mode).persist()
            try:
                # Edges: skipped on an empty batch.  Vertices: always written.
                write_graph_file(graph.oriented_edges(edges), f"{self.edges_path}/batch_id={batch_id}",
                                 self.fmt, mode="overwrite", skip_empty=True)
                write_graph_file(graph.extract_vertices(edges),
                                 f"{self.vertices_path}/batch_id={batch_id}", self.fmt, mode="overwrite")
                if self.graph_tables:
                    self.graph_tables.add(edges, batch_id)
            finally:
                edges.unpersist()
            self._running(event_bans(good), batch_id)
        finally:
            parsed.unpersist()

    def _running(self, bans: DataFrame, batch_id: int) -> None:
        """Per-ban running totals continuing from earlier batches' totals."""
        prior = self.totals.read(before_batch=batch_id).select(
            "champion", F.col("ban_count").alias("prior"))
        ranked = running_ban_count(bans).withColumnRenamed("running", "rn")
        prior = prior.withColumnRenamed("champion", "__champion")
        running = (ranked.join(prior, F.col("champion").eqNullSafe(F.col("__champion")), "left")
                   .select("match_id", "pos", "champion",
                           (F.col("rn") + F.coalesce("prior", F.lit(0))).alias("running"))
                   .withColumn("batch_id", F.lit(batch_id).cast("bigint"))).persist()
        try:
            (running.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(self.running_path))
            self.totals.upsert(running.groupBy("champion").agg(F.max("running").alias("ban_count")),
                               batch_id)
        finally:
            running.unpersist()


def start_match_event_sink(records: DataFrame, sink: MatchEventSink, checkpoint: str,
                           trigger: dict | None = None) -> StreamingQuery:
    w = records.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def run_available(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``availableNow`` query (as long as it takes, or ``timeout_s``); re-raise its failure."""
    finished = query.awaitTermination(timeout_s)
    if timeout_s is not None and not finished:
        query.stop()
        raise TimeoutError(f"streaming query {query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise query.exception()


def event_matches(records: DataFrame) -> DataFrame:
    """(ts, game_duration, winner) of every good event, for the windowed stats.

    Event time comes from the event itself (``ts``), not from the clock of
    the micro-batch as in the reference.
    """
    good, _ = split_quarantine(parse_events(records))
    return good.select("match_id", F.col("ts").try_cast("timestamp_ntz").alias("ts"),
                       F.col("gameDuration").try_cast("bigint").alias("game_duration"), "winner")


def start_match_jobs(records: DataFrame, root: str, trigger: dict | None = None,
                     watermark: str | None = None, fmt: str = "parquet",
                     reset: bool = False, time_basis: str = "event",
                     dedupe_matches: bool = False, id_mode: str = EVENT_ID_MODE,
                     graph_tables: GraphTables | None = None) -> dict[str, StreamingQuery]:
    """Start the whole streaming side over one (key, value) record stream.

    Two queries: the windowed statistics (stateful, watermarked) and one
    ``foreachBatch`` sink that parses each micro-batch once and writes the
    edges, vertices, per-ban running totals, quarantine and the ban-count
    table (the champions' latest totals).  Below ``root`` (a shared folder):
    ``ban_count`` and ``stats`` upsert tables, the ``edges``/``vertices``/
    ``running``/``quarantine`` outputs and one checkpoint per query.
    ``reset`` empties the tables first (the reference truncates on every
    start; by default we resume).  ``id_mode`` chooses the players' ids: a
    hash of the name (``xxhash64``, or ``murmur3`` for the reference's ids), or
    ``key`` for events whose ids are numeric keys.  ``graph_tables`` are brought up to date with every micro-batch.
    Without a watermark the statistics run by panes (``start_pane_stats``, table ``panes``).
    """
    spark = records.sparkSession
    ban = UpsertStore(spark, f"{root}/ban_count", ["champion"], schemas.BAN_COUNT).create()
    st = UpsertStore(spark, f"{root}/stats", ["slot"], schemas.MATCH_STATS).create()
    if reset:
        for s_ in (ban, st):
            s_.truncate()
    sink = MatchEventSink(f"{root}/edges", f"{root}/vertices", f"{root}/running", f"{root}/quarantine",
                          ban, fmt=fmt, id_mode=id_mode, graph_tables=graph_tables)
    dedupe_key = "match_id" if dedupe_matches else None
    if watermark:
        windows = start_sliding_stats(event_matches(records), st, f"{root}/_checkpoints/stats", watermark=watermark,
                                      trigger=trigger, time_basis=time_basis, dedupe_key=dedupe_key)
    else:
        panes = UpsertStore(spark, f"{root}/panes", ["slot"], schemas.MATCH_STATS).create()
        if reset:
            panes.truncate()
        windows = start_pane_stats(event_matches(records), panes, st, f"{root}/_checkpoints/panes", trigger=trigger,
                                   time_basis=time_basis, dedupe_key=dedupe_key)
    return {
        "stats": windows,
        "match_events": start_match_event_sink(records, sink, f"{root}/_checkpoints/match_events", trigger),
    }
