"""Bit-plane clustering and bit-sliced whitening against plain numpy."""

import hashlib

import numpy as np
import pytest
from conftest import SF_SMALL
from oracle import compare
from pyspark.sql import functions as F

from sparkrisk.llm import centroids as CE
from sparkrisk.llm import queries as Q
from sparkrisk.llm import whitening as WH

rng = np.random.default_rng(3)


def frame(llm, rows, extra=()):
    df = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({c: F.lit("extra") for c in extra}).repartition(3)


def vectors(n, d=64, spread=1.0):
    return [(i, [float(x) for x in np.float32(rng.normal(0, spread, d))]) for i in range(n)]


ODD = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 63 + [None]), (904, [float("nan")] + [1.0] * 63),
       (905, [float("inf")] + [0.0] * 63), (906, [0.0] * 64), (906, [0.0] * 64), (907, [2.0**18] * 32 + [-(2.0**18)] * 32),
       (908, [1e30] * 64), (None, [0.25] * 64), (955, [1.0] * 64), (909, [-0.001] * 64)]


def test_planes_are_exact():
    a = rng.integers(-(1 << 20), 1 << 20, (50, 64))
    b = rng.integers(-(1 << 9), 1 << 9, (7, 64))
    pa, pb = CE.planes_of(a, 21), CE.planes_of(b, 10)
    assert (CE.values_of(pa) == a).all() and (CE.values_of(pb) == b).all()
    assert (CE.dots(pa, pb) == a @ b.T).all() and (CE.norms(pa) == (a * a).sum(axis=1)).all()


def clusters(rows, k, rounds):
    kept = [(key, v) for key, v in rows if v is not None and len(v) == 64
            and all(x is not None and np.isfinite(x) and abs(x) < 2.0**19 for x in v)]
    x = np.floor(256 * np.array([np.float32(v).astype(float) for _, v in kept]).reshape(-1, 64)).astype(np.int64)
    order = sorted((i for i in range(len(kept)) if kept[i][0] is not None),
                   key=lambda i: (hashlib.sha256(f"2:{kept[i][0]}".encode()).hexdigest(), x[i].tolist()))
    c = x[order[:k]].copy()
    for r in range(rounds + 1):
        far = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        own = far.argmin(axis=1)
        for j in set(own.tolist()) if r < rounds else ():
            c[j] = x[own == j].sum(axis=0) // (own == j).sum()
    best = far.min(axis=1)
    sha = [hashlib.sha256(",".join(map(str, r.tolist())).encode()).hexdigest() for r in c]
    return sorted(((kept[i][0], int(own[i]), int(best[i]), int(best[own == own[i]].sum()), int(best.sum()), sha[own[i]])
                   for i in range(len(kept))), key=repr)


@pytest.mark.parametrize("k,rounds", [(40, 5), (3, 5), (7, 0)])
def test_clusters_equal_brute_force(llm, k, rounds):
    rows = vectors(300, spread=3.0) + [(400 + i, v) for i, v in vectors(20, spread=900.0)] + ODD
    got = CE.cluster_report(frame(llm, rows, ("cluster", "planes", "key", "n", "distance", "sums")), k=k, rounds=rounds)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == clusters(rows, k, rounds)


def test_clusters_of_a_vector_that_a_third_shares(llm):
    rows = vectors(200) + [(1000 + i, [0.5] * 64) for i in range(100)]
    assert sorted((tuple(r) for r in CE.cluster_report(frame(llm, rows)).collect()), key=repr) == clusters(rows, 40, 5)


def test_few_and_no_vectors(llm):
    rows = vectors(5)
    assert sorted((tuple(r) for r in CE.cluster_report(frame(llm, rows)).collect()), key=repr) == clusters(rows, 40, 5)
    assert CE.cluster_report(frame(llm, rows).limit(0)).count() == 0


def test_cluster_query_equals_sql(llm):
    ok, msg = compare(Q.queries()["op12_centroid_planes"](llm, SF_SMALL), Q.oracle_sql()["op12_centroid_planes"], SF_SMALL)
    assert ok, msg


def test_scatter_is_exact():
    for top in (3, 1 << 14, 1 << 40):
        x = rng.integers(-top, top, (130, 5))
        ones = np.hstack([x, np.ones((130, 1), np.int64)]).astype(object)
        assert (WH.scatter(x) == ones.T @ ones).all()


def whitened(rows, d):
    kept = [(k, v) for k, v in rows if v is not None and len(v) == d and all(x is not None and np.isfinite(x) and abs(x) < 2.0**34 for x in v)]
    x = np.floor(1024 * np.array([np.float32(v).astype(float) for _, v in kept])).astype(np.int64) + 100000
    n, s = len(x), [int(c) for c in x.astype(object).sum(axis=0)]
    dev = [sum((n * int(a) - b) ** 2 for a, b in zip(r, s)) for r in x]
    mean = np.array([b / n for b in s])
    e, u = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    return kept, n, dev, (x - mean) @ u[:, ::-1][:, :8] / np.sqrt(e[::-1][:8]), e[::-1][:8] / e.sum()


@pytest.mark.parametrize("d", [64, 5])
def test_whitening_equals_numpy(llm, d):
    rows = vectors(5000, d) + [(9000 + i, [0.5] * d) for i in range(50)] + [(None, [0.1] * d), (7, [0.2] * d)]
    rows += [(k, v) for k, v in ODD if v is None or len(v) != d or k in (903, 904, 905)]
    got = WH.whiten(frame(llm, rows, ("component", "n", "w", "x", "key", "deviation"))).collect()
    kept, n, dev, w, share = whitened(rows, d)
    parts = min(8, d)
    assert len(got) == parts * len(kept) and {r.n for r in got} == {n}
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted((str(k), v) for (k, _), v in zip(kept, dev))
    assert max(r.identity_error for r in got) < 1e-9
    by_dev = {v: i for i, v in enumerate(dev)}
    mine = np.zeros((len(kept), parts))
    for r in got:
        mine[by_dev[r.deviation], r.component - 1] = r.whitened
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-6
    seen = sorted(set(by_dev.values()))
    assert np.abs(np.abs(mine[seen]) - np.abs(w[seen])).max() < 1e-6
    signs = np.sign((mine[seen] * w[seen]).sum(axis=0))
    assert np.abs(mine[seen] * signs - w[seen]).max() < 1e-6


def test_whitening_edge_cases(llm):
    one = WH.whiten(frame(llm, [(1, [1.0, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [
        (1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    assert WH.whiten(frame(llm, vectors(4)).limit(0)).count() == 0
    line = WH.whiten(frame(llm, [(i, [float(i), 2.0 * i, 3.0]) for i in range(9)])).collect()  # one direction
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    assert abs(line[0].explained - 1) < 1e-12 and line[0].identity_error < 1e-9
    huge = WH.whiten(frame(llm, [(i, [float(i % 3) * 2.0**33, float(i)]) for i in range(1000)])).collect()
    assert {r.deviation for r in huge} == {None} and max(r.identity_error for r in huge) < 1e-4


def test_whitening_query(llm):
    rows = Q.queries()["op13_bit_sliced_whitening"](llm, SF_SMALL).collect()
    assert {r.component for r in rows} == set(range(1, 9)) and max(r.identity_error for r in rows) < 1e-4
