"""Summarise a Spark event log (zstd or plain): jobs, stages, durations.

Usage: python tools/stage_times.py <event-log-dir> [--last-half]
"""

from __future__ import annotations

import glob
import io
import json
import sys

import zstandard


def _lines(path: str):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main() -> None:
    root = sys.argv[1]
    stages, jobs, jstart = {}, {}, {}
    for path in glob.glob(f"{root}/**/events_*", recursive=True):
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev["Event"]
            if kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:50], si["Number of Tasks"], si["Submission Time"], si["Completion Time"] - si["Submission Time"])
            elif kind == "SparkListenerJobStart":
                jstart[ev["Job ID"]] = ev["Submission Time"]
            elif kind == "SparkListenerJobEnd":
                jobs[ev["Job ID"]] = ev["Completion Time"] - jstart[ev["Job ID"]]
    ids = sorted(stages)
    if "--last-half" in sys.argv:
        ids = ids[len(ids) // 2:]
    print(f"jobs {len(jobs)} stages {len(stages)}")
    t0 = stages[ids[0]][2] if ids else 0
    for sid in ids:
        name, ntasks, start, dur = stages[sid]
        print(f"{sid:4d} {name:50s} tasks={ntasks:4d} start+{start - t0:6d}ms dur={dur}ms")


if __name__ == "__main__":
    main()
