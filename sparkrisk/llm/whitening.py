"""Embedding whitening from a bit-sliced scatter matrix (operator 13).

Entries become integers ``floor(scale * c) + offset``. A task takes blocks of rows; in a block the
least value of every dimension is subtracted, and bit ``p`` of a dimension's values over 64 rows
is one word. The cross-product of two dimensions is the sum over pairs of planes of the popcount
of their AND, weighted with a power of two; a plane of ones gives the sums. Undoing the shift
in integers, and adding tasks as decimals, keeps everything exact, so the covariance is
centred as integers (``n * cross - sum * sum``) and becomes floating point in one division just
before the eigendecomposition on the driver, whose size depends on the dimensions alone.

Defined results: vectors that are null, empty, hold a null or non-finite entry, or have another
length than the most frequent one (the shorter on ties) are dropped, as are those with an integer
beyond ``2^45``. Components without variance (all of them for a single row) have no whitened value:
it is null, and ``identity_error`` leaves them out; ``explained`` is null if nothing varies. A
``deviation`` beyond a long is null. Repeated ids are separate rows; a null id is kept. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage

SCALE = 1024
OFFSET = 100_000
COMPONENTS = 8
LARGEST = 1 << 45
# Rows of a block: 64 words per plane keep the pairs of planes of a block in the processor's cache.
BLOCK = 4096
# Words of one intermediate array.
_WORDS = 1 << 19
# An eigenvalue below this share of the largest is rounding, not variance.
RANK = 1e-13


def planes_of(values: np.ndarray) -> np.ndarray:
    """``bits x d x words`` planes of ``rows x d`` integers from 0 on: bit ``r`` of the words of plane
    ``p`` and dimension ``d`` is bit ``p`` of row ``r``."""
    n, d = values.shape
    bits = max(1, int(values.max(initial=0)).bit_length())
    padded = np.zeros((d, -(-n // 64) * 64), dtype=np.int64)
    padded[:, :n] = values.T
    out = np.empty((bits, d, padded.shape[1] // 64), dtype=np.uint64)
    for p in range(bits):
        out[p] = np.packbits(((padded >> p) & 1).astype(np.uint8), axis=1, bitorder="little").view("<u8")
    return out


def cross_products(values: np.ndarray) -> np.ndarray:
    """Exact ``d x d`` sums of products over the rows, as Python integers."""
    planes = planes_of(values)
    bits, d, words = planes.shape
    step = max(1, _WORDS // (d * words))
    by_weight = np.zeros((2 * bits - 1, d, d), dtype=np.int64)
    for p in range(bits):
        for q in range(p, bits):
            count = np.empty((d, d), dtype=np.int64)
            for i in range(0, d, step):
                both = planes[p, i : i + step, None, :] & planes[q][None, :, :]
                count[i : i + step] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
            by_weight[p + q] += count if p == q else count + count.T
    if 2 * bits + len(values).bit_length() < 62:
        shifted = by_weight << np.arange(2 * bits - 1, dtype=np.int64)[:, None, None]
        return shifted.sum(axis=0).astype(object)
    return sum(by_weight[w].astype(object) << w for w in range(2 * bits - 1))


def scatter(values: np.ndarray) -> np.ndarray:
    """Exact ``(d + 1) x (d + 1)`` sums of products of ``rows x d`` integers and a column of ones."""
    least = values.min(axis=0)
    ones = np.ones((len(values), 1), dtype=np.int64)
    cross = cross_products(np.hstack([values - least, ones]))
    low = np.append(least, 0).astype(object)
    sums = cross[-1]
    return cross + np.outer(low, sums) + np.outer(sums, low) + np.outer(low, low) * len(values)


def integers(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE,
             offset: int = OFFSET) -> tuple[DataFrame, int]:
    """(key, x) of the rows that take part, unwritten, and their dimension."""
    wide = vectors[vec].cast("array<double>")
    ok = F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < (LARGEST - abs(offset)) / scale))
    good = vectors.filter(F.coalesce((F.size(wide) > 0) & ok, F.lit(False)))
    sizes = good.groupBy(F.size(vec).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    top = sizes.orderBy(F.col("n").desc(), "d").first()
    d = top["d"] if top else 0
    x = F.transform(wide, lambda c: F.floor(c * scale) + offset)
    return good.filter(F.size(vec) == d).select(vectors[key].alias("key"), x.alias("x")), d


def _matrix(column, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


@dataclass
class Whitening:
    """What is fitted: exact counts and sums, and the leading components."""

    n: int
    sums: list[int]
    vectors: np.ndarray  # d x components
    values: np.ndarray
    trace: float

    def ranked(self) -> np.ndarray:
        return self.values > RANK * max(self.values[0], 0) if len(self.values) else np.zeros(0, bool)


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Covariance (divisor n) of all rows and its leading eigenvectors, by falling eigenvalue."""
    import pyarrow as pa

    upper = np.triu_indices(d + 1)

    def run(batches: Iterator) -> Iterator:
        total, held, waiting = 0, [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(_matrix(batch.column(1), d))
                waiting += batch.num_rows
            if waiting >= BLOCK:
                block = np.concatenate(held)
                for i in range(0, len(block), BLOCK):
                    total = total + scatter(block[i : i + BLOCK])
                held, waiting = [], 0
        if held:
            total = total + scatter(np.concatenate(held))
        if not isinstance(total, int):
            sums = pa.array([Decimal(int(v)) for v in total[upper]], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), sums],
                                             names=["a", "b", "s"])

    parts = rows.mapInArrow(run, "a int, b int, s decimal(38,0)")
    cross: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("a", "b").agg(F.sum("s").alias("s")).collect():  # (d + 1)(d + 2) / 2 rows
        cross[r["a"], r["b"]] = int(r["s"])
    n = cross.get((d, d), 0)
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    sums = [cross[a, d] for a in range(d)]
    v = np.empty((d, d))
    for a in range(d):
        for b in range(a, d):
            v[a, b] = v[b, a] = (n * cross[a, b] - sums[a] * sums[b]) / (n * n)
    e, u = np.linalg.eigh(v)
    order = np.argsort(-e, kind="stable")[:components]
    trace = sum(n * cross[a, a] - sums[a] * sums[a] for a in range(d)) / (n * n)
    return Whitening(n, sums, u[:, order], e[order], trace)


def transform(rows: DataFrame, model: Whitening) -> DataFrame:
    """(key, deviation, whitened array<double>) of every row."""
    import pyarrow as pa

    n, sums = model.n, np.array(model.sums, dtype=object)
    whole, rest = np.array([s // n for s in model.sums], np.int64), np.array([(s % n) / n for s in model.sums])
    ok = model.ranked()
    unit = model.vectors / np.sqrt(np.where(ok, model.values, 1.0))

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), len(sums))
            centred = (x - whole) - rest  # the integer part is exact
            far = ((n * centred) ** 2).sum(axis=1)
            small = far < 2.0**62
            deviation = np.zeros(len(x), np.int64)
            if small.any():  # every n * x - S is below 2^31 here, so 64 bits hold the sum
                step = np.int64(n) * (x[small] - whole) - np.array([s % n for s in model.sums], np.int64)
                deviation[small] = (step * step).sum(axis=1)
            for i in np.nonzero(~small & (far < 2.0**64))[0]:  # near the limit: Python integers
                exact = sum((n * int(a) - s) ** 2 for a, s in zip(x[i], sums))
                small[i], deviation[i] = exact < 1 << 63, exact if exact < 1 << 63 else 0
            w = centred @ unit
            w[:, ~ok] = np.nan
            flat = pa.array(w.reshape(-1), pa.float64(), from_pandas=True)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * w.shape[1], flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviation, mask=~small), lists],
                                             names=["key", "deviation", "w"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, deviation long, w array<double>")


def whiten(vectors: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vec: str = "embedding",
           scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per vector and
    component."""
    rows, d = integers(vectors, key, vec, scale, offset)
    model = fit(rows, d, components)
    out = "component", "n", "deviation", "whitened", "explained", "identity_error"
    if not model.n:
        empty = vectors.select(vectors[key], F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                               F.lit(0).cast("long").alias("deviation"), *[F.lit(0.0).alias(c) for c in out[3:]])
        return empty.limit(0)
    done = stage(transform(rows, model), "whitened")
    ranked = np.nonzero(model.ranked())[0].tolist()
    error = None
    if ranked:  # covar_pop centres, then multiplies, and merges tasks
        pairs = [(i, j) for i in ranked for j in ranked if i <= j]
        got = done.agg(*[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
    explained = F.array(*[F.lit(s).cast("double") for s in shares])
    wide = done.select(F.col("key").alias(key), "deviation", F.posexplode("w").alias("__i", "whitened"))
    return wide.select(key, (F.col("__i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                       "whitened", explained[F.col("__i")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
