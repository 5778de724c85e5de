"""Randomized checks against brute force on small inputs (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkrisk.operators.sequence import ordered_window
from sparkrisk.operators.text import pad

ROWS = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "hot", None]),
        st.one_of(st.none(), st.integers(0, 6)),
        st.integers(0, 3),
        st.integers(-5, 5),
    ),
    min_size=1,
    max_size=60,
)

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _brute(rows):
    """Per key, order by (time nulls first, tie, uid): ordinal, previous v, running sum of v,
    and the sum of v over rows sharing (key, time)."""
    out = {}
    for k in {r[0] for r in rows}:
        part = sorted((r for r in rows if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[4]))
        acc, prev = 0, None
        for i, r in enumerate(part, 1):
            acc += r[3]
            same = [x[3] for x in part if x[1] == r[1]] if r[1] is not None else None
            out[r[4]] = (i, prev, acc, sum(same) if same is not None else -99)
            prev = r[3]
    return out


@SLOW
@given(rows=ROWS, parts=st.integers(1, 9), strategy=st.sampled_from(["range", "hash"]))
def test_ordered_window_matches_brute_force(spark, rows, parts, strategy):
    rows = [(k, t, tie, v, uid) for uid, (k, t, tie, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, t int, tie int, v int, uid int")
    got = ordered_window(df, "k", "t", ["tie", "uid"], row_number="rn", lags={"pv": "v"},
                         running_sums={"cum": "v"}, group_sums={"gs": "v"}, null_time_sum=-99,
                         strategy=strategy, num_partitions=parts)
    res = {r.uid: (r.rn, r.pv, r.cum, r.gs) for r in got.collect()}
    assert res == _brute(rows)


@SLOW
@given(arrays=st.lists(st.lists(st.integers(1, 50), max_size=12), min_size=1, max_size=8), n=st.integers(1, 10))
def test_pad_matches_definition(spark, arrays, n):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "i int, ids array<int>")
    got = {r.i: r.ids for r in pad(df, "ids", n=n).collect()}
    for i, a in enumerate(arrays):
        assert got[i] == ([0] * (n - len(a)) + a if len(a) < n else a[len(a) - n:])
