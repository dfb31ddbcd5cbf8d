"""Command line: the streaming job, the graph job and the dashboard marts.

    spark-submit --py-files skirmish.zip submit.py stream --kafka broker:9092 --root s3://bucket/matches
    python -m skirmish stream --json-dir /landing/events --root /data/matches --available-now
    python -m skirmish graph  --root /data/matches --k 3 --export /data/graph
    python -m skirmish marts  --root /data/matches

``--root`` must be a folder every executor sees (HDFS, S3, a shared mount):
upsert tables, edge/vertex files and checkpoints live below it.  Results of
``graph`` and ``marts`` are written there as Parquet; nothing is collected.
"""

from __future__ import annotations

import argparse

from .session import build_session, cluster_conf


def _session(args):
    extra = cluster_conf(args.cores) if args.cores else {}
    return build_session(app_name=f"skirmish-{args.cmd}", extra=extra)


def cmd_stream(args) -> None:
    from .sources import documents
    from .streaming import jobs

    spark = _session(args)
    if args.kafka:
        records = documents.kafka_stream(spark, args.kafka, args.topic)
    else:
        records = documents.json_record_stream(spark, args.json_dir, args.max_files)
    trigger = {"availableNow": True} if args.available_now else {"processingTime": args.trigger}
    queries = jobs.start_match_jobs(records, args.root, trigger=trigger, watermark=args.watermark,
                                    fmt=args.format, reset=args.reset, time_basis=args.time_basis,
                                    dedupe_matches=args.dedupe, id_mode=args.id_mode)
    if args.available_now:
        for q in queries.values():
            jobs.run_available(q, timeout_s=args.timeout)
    else:
        spark.streams.awaitAnyTermination()  # a failing query ends the job (and raises)


def cmd_graph(args) -> None:
    from . import schemas
    from .operators import graph
    from .streaming.store import UpsertStore

    spark = _session(args)
    bans = UpsertStore(spark, f"{args.root}/ban_count", ["champion"], schemas.BAN_COUNT).read()
    result = graph.graph_job(spark, f"{args.root}/edges", f"{args.root}/vertices", bans, k=args.k,
                             fmt=args.format, export_path=args.export)
    result.write.mode("overwrite").parquet(f"{args.root}/tracked_vs_banned")


def cmd_marts(args) -> None:
    from . import schemas
    from .operators import marts
    from .streaming.store import UpsertStore

    spark = _session(args)
    bans = UpsertStore(spark, f"{args.root}/ban_count", ["champion"], schemas.BAN_COUNT).read()
    slots = UpsertStore(spark, f"{args.root}/stats", ["slot"], schemas.MATCH_STATS).read()
    marts.top_bans_chart(bans, args.k).write.mode("overwrite").parquet(f"{args.root}/marts/top_bans")
    marts.avg_length(slots, source="slots").write.mode("overwrite").parquet(f"{args.root}/marts/avg_length")
    marts.win_share(slots, source="slots").write.mode("overwrite").parquet(f"{args.root}/marts/win_share")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="skirmish")
    p.add_argument("--cores", type=int, default=0, help="total executor cores (sizes shuffles)")
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("stream", help="ban counts, window stats, edge/vertex files from match events")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--json-dir", help="folder of JSON (key, value) records")
    s.add_argument("--topic", default="matches")
    s.add_argument("--root", required=True)
    s.add_argument("--trigger", default="5 minutes")
    s.add_argument("--available-now", action="store_true", help="process what is there, then stop")
    s.add_argument("--max-files", type=int, default=None)
    s.add_argument("--watermark", default=None,
                   help="drop events later than this behind the newest (default: none is ever late)")
    s.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    s.add_argument("--reset", action="store_true", help="empty the tables first")
    s.add_argument("--time-basis", default="event", choices=["event", "arrival"],
                   help="window statistics by match time or by arrival (processing) time")
    s.add_argument("--dedupe", action="store_true", help="count a match reported twice once")
    s.add_argument("--id-mode", default="xxhash64", choices=["xxhash64", "murmur3", "key"],
                   help="player ids: hash of the name, or the event's own numeric keys")
    s.add_argument("--timeout", type=int, default=None, help="seconds to wait with --available-now (default: no limit)")
    s.set_defaults(fn=cmd_stream)

    g = sub.add_parser("graph", help="tracked players vs the most banned champions")
    g.add_argument("--root", required=True)
    g.add_argument("--k", type=int, default=3)
    g.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    g.add_argument("--export", default=None, help="folder for USER nodes / BEAT relationships")
    g.set_defaults(fn=cmd_graph)

    m = sub.add_parser("marts", help="dashboard marts from the ban and stats tables")
    m.add_argument("--root", required=True)
    m.add_argument("--k", type=int, default=15)
    m.set_defaults(fn=cmd_marts)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
