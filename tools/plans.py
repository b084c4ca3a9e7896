"""Summarise the physical plans of registered queries: shuffles, broadcasts, joins, windows, scans.

usage: python tools/plans.py [sf_dir] [query ...]   (prints a Markdown table)
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "round-robin": r"Exchange RoundRobinPartitioning",
    "broadcasts": r"BroadcastExchange",
    "SMJ": r"SortMergeJoin",
    "BHJ": r"BroadcastHashJoin",
    "cartesian/BNLJ": r"CartesianProduct|BroadcastNestedLoopJoin",
    "windows": r"\bWindow \[",
    "subqueries": r"Subquery subquery",
}


def summarise(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    row = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    row["max scan cols"] = max((len(s.split(",")) for s in schemas if s), default=0)
    return row


def main():
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir, args = args[0], args[1:]
    from bench import HEADLINE
    from loanflow.catalog import REGISTRY
    from loanflow.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    names = args or HEADLINE
    cols = list(PATTERNS) + ["max scan cols"]
    print("| query | " + " | ".join(cols) + " |")
    print("|" + " --- |" * (len(cols) + 1))
    for name in names:
        if name.startswith("train_") or name.startswith("stream_"):
            continue  # fitting / streaming run jobs while they are built
        row = summarise(REGISTRY[name](spark, sf_dir))
        print(f"| {name} | " + " | ".join(str(row[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
