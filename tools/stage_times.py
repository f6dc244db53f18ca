"""Summarise a Spark event log: per job group of stages, wall time, tasks, input bytes and
shuffle bytes written / read.

    python tools/stage_times.py EVENT_LOG_FILE_OR_DIR [--top N]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _files(path: str) -> list[str]:
    """Event log files under ``path`` (plain logs, or the rolling ``eventlog_v2_*`` folders)."""
    if not os.path.isdir(path):
        return [path]
    found = glob.glob(os.path.join(path, "**", "*"), recursive=True)
    return sorted(f for f in found if os.path.isfile(f) and not os.path.basename(f).startswith("appstatus"))


def _open(path: str):
    """Text lines of one event log file; Spark compresses them with zstd by default."""
    if path.endswith(".zstd"):
        import zstandard

        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    return open(path, encoding="utf-8")


def summarise(path: str) -> list[dict]:
    stages = {}
    for f in _files(path):
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a["Name"]: a.get("Value") for a in info.get("Accumulables", [])}

                def num(name):
                    v = acc.get(name)
                    return int(v) if isinstance(v, (int, str)) and str(v).isdigit() else 0

                stages[info["Stage ID"]] = {
                    "stage": info["Stage ID"],
                    "name": info["Stage Name"].split(" at ")[0],
                    "tasks": info["Number of Tasks"],
                    "ms": info.get("Completion Time", 0) - info.get("Submission Time", 0),
                    "input_bytes": num("internal.metrics.input.bytesRead"),
                    "shuffle_write_bytes": num("internal.metrics.shuffle.write.bytesWritten"),
                    "shuffle_read_bytes": num("internal.metrics.shuffle.read.remoteBytesRead")
                    + num("internal.metrics.shuffle.read.localBytesRead"),
                }
    return [stages[k] for k in sorted(stages)]


def main(argv: list[str]) -> None:
    rows = summarise(argv[1])
    top = int(argv[argv.index("--top") + 1]) if "--top" in argv else len(rows)
    rows = sorted(rows, key=lambda r: -r["ms"])[:top]
    print(f"{'stage':>5} {'ms':>7} {'tasks':>5} {'input':>12} {'shuf.write':>11} {'shuf.read':>10}  name")
    for r in rows:
        print(f"{r['stage']:>5} {r['ms']:>7} {r['tasks']:>5} {r['input_bytes']:>12} "
              f"{r['shuffle_write_bytes']:>11} {r['shuffle_read_bytes']:>10}  {r['name']}")


if __name__ == "__main__":
    main(sys.argv)
