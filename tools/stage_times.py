"""Summarise a Spark event log: slowest stages and time per job group.

    python tools/stage_times.py /tmp/run-XXXX/eventlog_v2_local-.../ [top]

Reads the JSON-lines event files (no UI, no server) and prints the stages
with the longest wall time, with their task count and name.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import zstandard
        with open(f, "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            yield from text
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def events(path: str):
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    for f in files:
        if os.path.basename(f).startswith("appstatus"):
            continue
        for line in _lines(f):
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main(argv: list[str]) -> None:
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stages = []
    for e in events(path):
        if e.get("Event") == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                               info["Stage Name"][:70]))
    stages.sort(reverse=True)
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s summed wall time")
    for ms, sid, n, name in stages[:top]:
        print(f"{ms / 1000:7.2f}s  stage {sid:5d}  tasks {n:5d}  {name}")


if __name__ == "__main__":
    main(sys.argv)
