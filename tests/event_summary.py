"""Summarize a Spark event log (uncompressed): one line per completed stage.

    python tests/event_summary.py <event-log-dir> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def stages(log_dir: str):
    out = []
    for f in glob.glob(os.path.join(log_dir, "**"), recursive=True):
        if not os.path.isfile(f):
            continue
        for line in open(f, errors="replace"):
            try:
                e = json.loads(line)
            except ValueError:
                continue
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time") or 0) - (si.get("Submission Time") or 0)
                out.append((dur / 1000, si["Number of Tasks"], si["Stage ID"], si["Stage Name"][:60]))
    return out


def main():
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stages(sys.argv[1]), reverse=True)[:top]
    for dur, tasks, sid, name in rows:
        print(f"{dur:6.2f}s  tasks {tasks:4d}  stage {sid:4d}  {name}")


if __name__ == "__main__":
    main()
