"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is fully materialised with the no-op sink (every row computed,
nothing collected to the driver), BENCH_REPEAT times after one warm-up run;
the per-query figure is the median.  Prints exactly one JSON line on stdout.
With BENCH_EVENT_LOG=<folder>, Spark's event log is written there;
``scripts/stage_times.py <folder>`` summarises it per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "normalize_match_event", "normalize_bans", "normalize_edges", "nested_event_roundtrip",
    "ban_counts", "ban_running_count", "top_banned", "stats_sliding", "match_list_slice",
    "graph_vertices", "graph_degrees", "tracked_players_vs_banned", "pattern_match_hop",
    "mart_avg_length", "mart_win_share", "ban_counts_stream", "stats_sliding_stream",
]


def main() -> None:
    from skirmish.plans.queries import REGISTRY
    from skirmish.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {"spark.driver.memory": "16g"}
    event_log = os.environ.get("BENCH_EVENT_LOG")  # folder for Spark's event log (stage/task times)
    if event_log:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(f"local[{cpus}]", app_name="skirmish-bench", shuffle_partitions=2 * cpus,
                          extra=extra)

    def run(name: str) -> float:
        spark.sparkContext.setJobGroup(name, name)  # stage times per query in the event log
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("tracked_players_vs_banned")  # JVM / code-path warm-up
    times = {}
    for name in names:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(repeat)), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
