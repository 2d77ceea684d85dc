"""Stage timings of registered queries from Spark's event log.

    python tools/stage_times.py [sf_dir] key [key ...]

Runs each key (no-op sink) with the event log written to a fresh scratch
folder, then prints, per key, its jobs' stages with task count, wall time,
summed task time, shuffle read / write bytes and spill.  No UI or server is
used: the log is a local JSON-lines file.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sessionkit.plans.catalog import QUERIES  # noqa: E402
from sessionkit.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-", dir="/tmp")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false"})
    marks = []
    for key in args:
        spark.sparkContext.setJobGroup(key, key)
        QUERIES[key](spark, sf).write.format("noop").mode("overwrite").save()
        marks.append(key)
    spark.stop()
    stages, job_group, stage_job = {}, {}, {}
    paths = [p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(p) and not os.path.basename(p).startswith("appstatus")]
    for path in sorted(paths):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    props = ev.get("Properties") or {}
                    job_group[ev["Job ID"]] = props.get("spark.jobGroup.id", "?")
                    for sid in ev.get("Stage IDs", []):
                        stage_job[sid] = ev["Job ID"]
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    stages[info["Stage ID"]] = {
                        "name": info["Stage Name"][:60], "tasks": info["Number of Tasks"],
                        "wall_ms": (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0),
                        "task_ms": acc.get("internal.metrics.executorRunTime", 0),
                        "shuffle_read": acc.get("internal.metrics.shuffle.read.localBytesRead", 0),
                        "shuffle_write": acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                        "spill": acc.get("internal.metrics.diskBytesSpilled", 0)}
    for key in marks:
        rows = [(sid, st) for sid, st in sorted(stages.items())
                if job_group.get(stage_job.get(sid)) == key]
        total = sum(st["wall_ms"] for _, st in rows)
        print(f"## {key}: {len(rows)} stages, {total} ms stage wall time")
        for sid, st in rows:
            print(f"  stage {sid:4d} tasks={st['tasks']:4d} wall={st['wall_ms']:6d}ms "
                  f"task={st['task_ms']}ms shuffle r/w={st['shuffle_read']}/{st['shuffle_write']}B "
                  f"spill={st['spill']}B  {st['name']}")


if __name__ == "__main__":
    main()
