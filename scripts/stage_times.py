"""Per-query stage summary from a Spark event log (no UI needed).

    BENCH_EVENT_LOG=$(mktemp -d) python bench.py
    python scripts/stage_times.py <that folder>

Jobs are attributed to the query through their job group (bench.py sets one
per query).  For each query: jobs, stages, tasks, summed executor run time,
shuffle bytes written and read.
"""

from __future__ import annotations

import glob
import json
import os
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of an event-log file, plain or zstd-compressed (Spark's default codec)."""
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path) as fh:
            yield from fh


def summarise(log_dir: str) -> dict[str, dict[str, float]]:
    stats: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    stage_group: dict[int, str] = {}
    metrics = {"internal.metrics.executorRunTime": ("run_ms", 1.0),
               "internal.metrics.shuffle.write.bytesWritten": ("shuffle_write_mb", 2.0 ** -20),
               "internal.metrics.shuffle.read.remoteBytesRead": ("shuffle_read_mb", 2.0 ** -20),
               "internal.metrics.shuffle.read.localBytesRead": ("shuffle_read_mb", 2.0 ** -20)}
    for path in sorted(glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)):
        if os.path.isdir(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "(none)")
                stats[group]["jobs"] += 1
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                group = stage_group.get(info["Stage ID"], "(none)")
                stats[group]["stages"] += 1
                stats[group]["tasks"] += info.get("Number of Tasks", 0)
                for acc in info.get("Accumulables", []):
                    if acc.get("Name") in metrics:
                        col, scale = metrics[acc["Name"]]
                        stats[group][col] += float(acc.get("Value", 0)) * scale
    return stats


def main() -> None:
    stats = summarise(sys.argv[1])
    cols = ["jobs", "stages", "tasks", "run_ms", "shuffle_write_mb", "shuffle_read_mb"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---:|" * len(cols))
    for group in sorted(stats):
        row = stats[group]
        print(f"| {group} | " + " | ".join(f"{row[c]:.1f}" if "mb" in c else f"{int(row[c])}" for c in cols) + " |")


if __name__ == "__main__":
    main()
