"""Run every registered query against its oracle (like the driver's check).

    python tests/check_all.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import sys
import time

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parent))

from oracle import compare  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from sparkrisk.session import local_session, stage_scope  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picks = sys.argv[2:]
    spark = local_session(shuffle_partitions=int(__import__("os").environ.get("CHECK_SHUFFLE_PARTITIONS", "8")))
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if picks and not any(p in k for p in picks):
            continue
        t = time.time()
        try:
            with stage_scope(spark):
                df = fn(spark, sf_dir)
                if k in sqls:
                    ok, msg = compare(df, sqls[k], sf_dir)
                else:
                    n = df.count()
                    ok, msg = True, f"{n} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"{type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:40s} {time.time() - t:6.1f}s {msg}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
