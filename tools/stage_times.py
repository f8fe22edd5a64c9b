"""Summarise a Spark event log: wall time, tasks and shuffle bytes per stage.

    BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py summary_max
    python tools/stage_times.py $BENCH_EVENT_LOG_DIR/<app-id> [top]
"""
import io
import json
import os
import sys


def _lines(path):
    """Lines of an event log: a file, or a rolling-log folder; zstd or plain."""
    files = ([os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("events_")]
             if os.path.isdir(path) else [path])
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main(path, top=15):
    stages = []
    for line in _lines(path):
        e = json.loads(line)
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a["Name"]: a.get("Value") for a in si.get("Accumulables", [])}
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:60],
                           int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                           int(acc.get("internal.metrics.executorRunTime", 0) or 0) / 1000))
    stages.sort(reverse=True)
    print(f"{'sec':>6} {'stage':>5} {'tasks':>5} {'task-sec':>8} {'shuffleMB':>9}  name")
    for dur, sid, n, name, wbytes, run in stages[:top]:
        print(f"{dur:6.2f} {sid:5d} {n:5d} {run:8.2f} {wbytes / 1e6:9.2f}  {name}")
    print(f"total stages={len(stages)} sum(stage sec)={sum(s[0] for s in stages):.2f} "
          f"sum(task sec)={sum(s[5] for s in stages):.2f}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)
