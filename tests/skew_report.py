"""Task balance of the history job when one entity holds a third of the rows.

    python tests/skew_report.py [hash|range] [sf_dir]

Runs C3 on the hot-entity records with partition coalescing off, writes the event log to a
fresh scratch folder and prints, per shuffle-reading stage, the largest task's share.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sparkrisk.operators import history as H  # noqa: E402
from sparkrisk.plans import q_history as QH  # noqa: E402
from sparkrisk.session import local_session  # noqa: E402


def main():
    strategy = sys.argv[1] if len(sys.argv) > 1 else "range"
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="sparkrisk-skew-")
    spark = local_session(shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false"})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    H.build_history(QH.hot_events(spark, sf_dir), strategy=strategy).write.format("noop").mode("overwrite").save()
    spark.stop()
    tasks: dict[int, list[int]] = {}
    for f in glob.glob(os.path.join(log_dir, "**"), recursive=True):
        if not os.path.isfile(f):
            continue
        for line in open(f, errors="replace"):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerTaskEnd" and e.get("Task Metrics"):
                read = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                tasks.setdefault(e["Stage ID"], []).append(read)
    total = max((sum(v) for v in tasks.values()), default=0)
    for sid in sorted(tasks):
        v = tasks[sid]
        if sum(v) >= total * 0.5 and sum(v) > 0:
            print(f"{strategy}: stage {sid}: {len(v)} tasks, largest {max(v)} of {sum(v)} rows "
                  f"({100 * max(v) / sum(v):.0f}%)")


if __name__ == "__main__":
    main()
