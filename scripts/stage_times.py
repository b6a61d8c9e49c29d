"""Per-stage task times and skew from a Spark event log (no UI needed).

    BENCH_EVENT_LOG=/tmp/run-x/events python bench.py match_report
    python scripts/stage_times.py /tmp/run-x/events/<app-id>

For every completed stage: number of tasks, median and maximum task time,
and the largest task's share of the stage's input records (1/tasks when
even; near 1 when one task does the stage's work).
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _event_files(path: str) -> list[str]:
    """A single log file, or the ``events_N_*`` parts of a rolling log folder."""
    if not os.path.isdir(path):
        return [path]
    parts = [f for f in os.listdir(path) if f.startswith("events_")]
    parts.sort(key=lambda f: int(f.split("_")[1]))
    return [os.path.join(path, f) for f in parts]


def read_events(path: str):
    for name in _event_files(path):
        with open(name, "rb") as raw:
            if name.endswith(".zstd"):
                import zstandard

                stream = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            else:
                stream = raw
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def summarise(path: str) -> list[dict]:
    tasks = defaultdict(list)
    names = {}
    for ev in read_events(path):
        kind = ev.get("Event")
        if kind == "SparkListenerTaskEnd" and ev.get("Task End Reason", {}).get("Reason") == "Success":
            info, metrics = ev["Task Info"], ev.get("Task Metrics") or {}
            records = (metrics.get("Input Metrics") or {}).get("Records Read", 0) + (
                metrics.get("Shuffle Read Metrics") or {}
            ).get("Total Records Read", 0)
            tasks[ev["Stage ID"]].append((info["Finish Time"] - info["Launch Time"], records))
        elif kind == "SparkListenerStageCompleted":
            stage = ev["Stage Info"]
            names[stage["Stage ID"]] = stage.get("Stage Name", "")
    rows = []
    for stage_id in sorted(tasks):
        times = [t for t, _ in tasks[stage_id]]
        records = [r for _, r in tasks[stage_id]]
        total = sum(records)
        rows.append(
            {
                "stage": stage_id,
                "name": names.get(stage_id, "")[:60],
                "tasks": len(times),
                "median_ms": int(statistics.median(times)),
                "max_ms": max(times),
                "records": total,
                "largest_share": round(max(records) / total, 3) if total else 0.0,
            }
        )
    return rows


def main(argv: list[str]) -> None:
    print("| stage | tasks | median ms | max ms | records | largest task share | name |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for r in summarise(argv[0]):
        print(
            f"| {r['stage']} | {r['tasks']} | {r['median_ms']} | {r['max_ms']} | {r['records']} | "
            f"{r['largest_share']} | {r['name']} |"
        )


if __name__ == "__main__":
    main(sys.argv[1:])
