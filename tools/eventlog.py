"""Stage and task statistics of registered queries from Spark's event log.

usage: python tools/eventlog.py [sf_dir] [query ...]   (default sf0.1, the bench's headline queries)

Runs each query through the no-op sink in its own job group, with the event
log written to a fresh folder under /tmp, then reads the log back and prints a
Markdown table per query: jobs, stages, tasks, longest and median task, the
worst stage's longest/median task ratio (skew), shuffle bytes written and
bytes spilled.  The Spark UI stays off.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def read_events(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "**", "*"), recursive=True)):
        if not os.path.isfile(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                yield json.loads(line)


def summarise(folder: str) -> dict:
    stage_group, jobs, tasks = {}, defaultdict(set), defaultdict(list)
    for ev in read_events(folder):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
            if group:
                jobs[group].add(ev["Job ID"])
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
        elif kind == "SparkListenerTaskEnd":
            info, m = ev.get("Task Info", {}), ev.get("Task Metrics") or {}
            tasks[ev["Stage ID"]].append({
                "ms": info.get("Finish Time", 0) - info.get("Launch Time", 0),
                "shuffle_write": (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0),
                "spill": m.get("Memory Bytes Spilled", 0) + m.get("Disk Bytes Spilled", 0),
            })
    out = {}
    for group in jobs:
        stages = [s for s, g in stage_group.items() if g == group and tasks.get(s)]
        all_ms = [t["ms"] for s in stages for t in tasks[s]]
        skew = max((max(t["ms"] for t in tasks[s]) / max(statistics.median(t["ms"] for t in tasks[s]), 1)
                    for s in stages if len(tasks[s]) >= 4), default=1.0)
        out[group] = {
            "jobs": len(jobs[group]), "stages": len(stages), "tasks": len(all_ms),
            "max task ms": max(all_ms, default=0), "median task ms": int(statistics.median(all_ms)) if all_ms else 0,
            "worst skew": round(skew, 1),
            "shuffle MB": round(sum(t["shuffle_write"] for s in stages for t in tasks[s]) / 2**20, 1),
            "spill MB": round(sum(t["spill"] for s in stages for t in tasks[s]) / 2**20, 1),
        }
    return out


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.1"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from bench import HEADLINE
    from loanflow.catalog import REGISTRY
    from loanflow.session import local_session

    folder = tempfile.mkdtemp(prefix="loanflow-eventlog-")
    spark = local_session(8, app="loanflow-eventlog",
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": folder,
                                 "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    names = args or HEADLINE
    for name in names:
        sc.setJobGroup(name, name)
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    sc.setJobGroup("done", "done")
    spark.stop()
    stats = summarise(folder)
    cols = ["jobs", "stages", "tasks", "max task ms", "median task ms", "worst skew", "shuffle MB", "spill MB"]
    print(f"event log: {folder}")
    print("| query | " + " | ".join(cols) + " |")
    print("|" + " --- |" * (len(cols) + 1))
    for name in names:
        row = stats.get(name)
        if row:
            print(f"| {name} | " + " | ".join(str(row[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
