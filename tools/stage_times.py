"""Summarise stage timings from a Spark event log folder (written with spark.eventLog.dir).

Usage: python tools/stage_times.py <event-log-dir-or-file> [top_n]
Prints the slowest stages (duration, tasks, name) and per-job totals.
"""

from __future__ import annotations

import json
import os
import sys


def events(path: str):
    if os.path.isdir(path):  # Spark 4 writes one folder per application with rolling files
        files = sorted(os.path.join(root, f) for root, _, names in os.walk(path) for f in names
                       if not f.startswith("."))
    else:
        files = [path]
    for f in files:
        if f.endswith(".zstd") or f.endswith(".zst"):
            import io

            import zstandard
            fh = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(f, "rb")), encoding="utf-8")
        else:
            fh = open(f, encoding="utf-8")
        with fh:
            for line in fh:
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], []
    for e in events(path):
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            if "Submission Time" in info and "Completion Time" in info:
                stages.append((info["Completion Time"] - info["Submission Time"], info["Number of Tasks"],
                               info["Stage ID"], info["Stage Name"]))
        elif kind == "SparkListenerJobStart":
            jobs.append((e["Job ID"], e["Submission Time"]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {len(jobs)} jobs, stage time total {total / 1000:.1f}s")
    for ms, tasks, sid, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:7.2f}s  tasks={tasks:4d}  stage={sid:5d}  {name[:90]}")


if __name__ == "__main__":
    main()
