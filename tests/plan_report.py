"""Count plan nodes of the headline queries (initial adaptive plan, before execution).

    python tests/plan_report.py [sf_dir]

A query whose ordered window is materialized shows the part after the checkpoint; the
checkpoint job itself is range exchange + one hash exchange + windows.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
from bench import HEADLINE  # noqa: E402
from sparkrisk.session import local_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(shuffle_partitions=16)
    qs = E.queries()
    print("| query | hash shuffles | range shuffles | broadcasts | windows | aggregates | scans (with pushed filters) |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for k in HEADLINE:
        df = qs[k](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        n = lambda pat: len(re.findall(pat, plan))
        scans = n(r"FileScan parquet|FileScan json|FileScan csv|Scan ExistingRDD|Scan ")
        pushed = n(r"PushedFilters: \[[^\]]+\]")
        aggs = n(r"HashAggregate\(|SortAggregate\(|ObjectHashAggregate\(")
        print(f"| {k} | {n(r'Exchange hashpartitioning')} | {n(r'Exchange rangepartitioning')} | "
              f"{n(r'BroadcastExchange')} | {n(r'Window ')} | {aggs} | {scans} ({pushed}) |")


if __name__ == "__main__":
    main()
