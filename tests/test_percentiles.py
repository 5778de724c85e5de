"""Exact percentiles by narrowing, against sorting."""

import math
import random

import pytest

from sparkrisk.operators import profile as PR

rng = random.Random(11)
SHARES = (0.0, 0.001, 0.25, 0.5, 0.75, 0.999, 1.0)
CASES = {
    "hot": [7.0] * 3000 + [float(i) for i in range(3000)],
    "spread": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(4000)],
    "ints": [float(rng.randrange(10**9)) for _ in range(5000)],
    "few": [3.0, 1.0, None, 2.0],
    "one": [5.0],
    "equal": [2.5] * 100,
    "nulls": [None, None],
    "none": [],
    "nan": [float("nan")] * 5 + [1.0, 2.0, 3.0],
    "infinite": [float("-inf"), float("inf"), 0.0, 1.0, 1.0],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("sketch", [PR.SKETCH, 20])
def test_percentiles_equal_sorting(spark, monkeypatch, case, sketch):
    monkeypatch.setattr(PR, "SKETCH", sketch)
    values = CASES[case]
    df = spark.createDataFrame([(v,) for v in values], "`a b` double").repartition(4)
    got = PR.exact_percentiles(df, {"a b": SHARES})
    own = sorted(v for v in values if v is not None and v == v)
    want = {("a b", p): own[max(1, math.ceil(p * len(own))) - 1] if own else None for p in SHARES}
    assert got == want
