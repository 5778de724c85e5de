"""Centroid clustering by bit-plane popcounts (operator 12).

A vector of 64 components becomes 64 integers ``floor(scale * x)``. Bit ``p`` of all of them is one
64-bit word, so a vector is as many words as its integers have bits (two's complement: the last
word holds the signs). The dot product with a centroid is the sum over pairs of planes of the
popcount of their AND, weighted with a power of two; from it, and from the norms that the same
popcounts give, come exact squared distances. The planes are written once; every round reads
those few words, keeps the centroids in each task and returns one row per centroid and task
with the count and the sums of its components, so only ``k`` rows reach the driver, whatever
the table's size. No vector is shuffled, and a vector that many rows share is no hot group.

Defined results: vectors that are null, have another length than 64, or a null or non-finite
component take no part, nor do those with an integer outside ``[-2^27, 2^27)``, whose distances
may not fit a long. Rows without an id are assigned and counted, but start no centroid. Repeated
ids are separate vectors; those with different vectors start centroids in the order of their packed planes.
Fewer vectors than ``k`` give as many centroids; an empty table gives an empty result. Sums of
distances beyond a long are null. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.llm.common import stage

DIMENSIONS = 64  # one bit each in a word
K = 40
ROUNDS = 5
SCALE = 256
LARGEST = 1 << 27
# Vectors compared at a time: bounds the arrays of a task.
BLOCK = 8192


def planes_of(values: np.ndarray, bits: int) -> np.ndarray:
    """``n x bits`` words from ``n x 64`` integers: bit ``d`` of word ``p`` is bit ``p`` of component
    ``d``; ``bits`` includes the sign."""
    shifts = np.arange(bits, dtype=np.int64)
    bit = ((values[:, None, :] >> shifts[None, :, None]) & 1).astype(np.uint8)
    return np.packbits(bit, axis=2, bitorder="little").view("<u8").reshape(len(values), bits)


def values_of(planes: np.ndarray) -> np.ndarray:
    """The ``n x 64`` integers that ``planes_of`` packed."""
    n, bits = planes.shape
    bit = np.unpackbits(np.ascontiguousarray(planes).view(np.uint8).reshape(n, bits, 8), axis=2, bitorder="little")
    return np.einsum("npd,p->nd", bit, plane_weights(bits))


def plane_weights(bits: int) -> np.ndarray:
    """Powers of two; the sign plane counts negative."""
    w = np.int64(1) << np.arange(bits, dtype=np.int64)
    w[-1] = -w[-1]
    return w


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact dot products (``n x k``) of packed vectors: weighted popcounts of ANDed planes."""
    wa, wb = plane_weights(a.shape[1]), plane_weights(b.shape[1])
    out = np.zeros((len(a), len(b)), dtype=np.int64)
    for p in range(a.shape[1]):
        for q in range(b.shape[1]):
            out += np.bitwise_count(a[:, p, None] & b[None, :, q]).astype(np.int64) * (wa[p] * wb[q])
    return out


def norms(planes: np.ndarray) -> np.ndarray:
    """Exact squared lengths of packed vectors."""
    w = plane_weights(planes.shape[1])
    out = np.zeros(len(planes), dtype=np.int64)
    for p in range(len(w)):
        for q in range(p, len(w)):
            twice = 1 if p == q else 2
            out += np.bitwise_count(planes[:, p] & planes[:, q]).astype(np.int64) * (w[p] * w[q] * twice)
    return out


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest packed centroid; the smaller number on ties."""
    far = norms(planes)[:, None] - 2 * dots(planes, centroids) + norms(centroids)[None, :]
    best = far.argmin(axis=1)
    return best, far[np.arange(len(far)), best]


def _usable(vec: Column) -> Column:
    ok = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vec) == DIMENSIONS) & ok, F.lit(False))


def packed(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", scale: int = SCALE) -> tuple[DataFrame, int]:
    """(key, planes) of the vectors that take part, written once, and the number of planes."""
    import pyarrow as pa

    wide = vectors[vec].cast("array<double>")
    # Beyond the limit the floor itself may not fit a long: the doubles are compared.
    fits = (F.array_min(wide) >= -LARGEST / scale) & (F.array_max(wide) < LARGEST / scale)
    whole = F.transform(wide, lambda x: F.floor(x * scale))
    own = vectors.filter(_usable(wide) & fits).select(vectors[key].alias("key"), whole.alias("x"))
    ends = own.agg(F.min(F.array_min("x")).alias("low"), F.max(F.array_max("x")).alias("high")).first()
    low, high = ends["low"] or 0, ends["high"] or 0
    bits = max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            words = planes_of(x, bits).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, words.size + 1, bits, dtype=np.int32), words.reshape(-1))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["key", "planes"])

    kind = vectors.schema[key].dataType.simpleString()
    return stage(own.mapInArrow(run, f"key {kind}, planes array<long>"), "planes"), bits


def _blocks(batches: Iterator, bits: int) -> Iterator:
    """(keys, planes) of up to ``BLOCK`` vectors at a time."""
    import pyarrow as pa

    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK:
            whole = pa.Table.from_batches(held).combine_chunks()
            yield whole.column(0), _words(whole.column(1), bits)
            held, rows = [], 0
    if rows:
        whole = pa.Table.from_batches(held).combine_chunks()
        yield whole.column(0), _words(whole.column(1), bits)


def _words(column, bits: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).view(np.uint64).reshape(-1, bits)


def start(planes: DataFrame, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of ``<salt>:<key>``, in that order."""
    order = F.sha2(F.concat(F.lit(salt + ":"), F.col("key").cast("string")), 256)
    first = planes.filter(F.col("key").isNotNull()).select(order.alias("h"), "planes").orderBy("h", "planes").limit(k)
    rows = [r["planes"] for r in first.collect()]  # at most k rows
    return values_of(np.array(rows, dtype=np.int64).view(np.uint64)) if rows else np.zeros((0, DIMENSIONS), np.int64)


def move(planes: DataFrame, centroids: np.ndarray, bits: int) -> np.ndarray:
    """Centroids after one round: the floors of the means of their vectors; empty ones stay."""
    import pyarrow as pa

    packed_centroids, k = planes_of(centroids, bits), len(centroids)

    def run(batches: Iterator) -> Iterator:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, DIMENSIONS), np.int64)
        for _, block in _blocks(batches, bits):
            own, _ = nearest(block, packed_centroids)
            order = np.argsort(own, kind="stable")
            at = np.unique(own[order], return_index=True)
            sums[at[0]] += np.add.reduceat(values_of(block[order]), at[1], axis=0)
            counts += np.bincount(own, minlength=k)
        got = np.nonzero(counts)[0]
        if len(got):
            flat = pa.ListArray.from_arrays(np.arange(len(got) + 1, dtype=np.int32) * DIMENSIONS, sums[got].reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(got.astype(np.int32)), pa.array(counts[got]), flat],
                                             names=["cluster", "n", "sums"])

    parts = planes.mapInArrow(run, "cluster int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(DIMENSIONS)]
    moved = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect():  # k rows
        moved[r["cluster"]] = [r[f"s{d}"] // r["n"] for d in range(DIMENSIONS)]
    return moved


def assign(planes: DataFrame, centroids: np.ndarray, bits: int) -> DataFrame:
    """(key, cluster, distance) of every vector."""
    import pyarrow as pa

    packed_centroids = planes_of(centroids, bits)

    def run(batches: Iterator) -> Iterator:
        for keys, block in _blocks(batches, bits):
            own, far = nearest(block, packed_centroids)
            yield pa.RecordBatch.from_arrays([keys.combine_chunks(), pa.array(own.astype(np.int32)), pa.array(far)],
                                             names=["key", "cluster", "distance"])

    kind = planes.schema["key"].dataType.simpleString()
    return planes.mapInArrow(run, f"key {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, scale: int = SCALE, salt: str = "2",
            key: str = "vec_id", vec: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((key, cluster, distance) of every vector, the final centroids' integer components)."""
    planes, bits = packed(vectors, key, vec, scale)
    centroids = start(planes, k, salt)
    if not len(centroids):
        kind = vectors.schema[key].dataType
        empty = T.StructType([T.StructField(key, kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
        return vectors.sparkSession.createDataFrame([], empty), centroids
    for _ in range(rounds):
        moved = move(planes, centroids, bits)
        if (moved == centroids).all():  # nothing will change any more
            break
        centroids = moved
    return assign(planes, centroids, bits).withColumnRenamed("key", key), centroids


def cluster_report(vectors: DataFrame, key: str = "vec_id", vec: str = "embedding", **options) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    spark = vectors.sparkSession
    rows, centroids = cluster(vectors, key=key, vec=vec, **options)
    rows = stage(rows, "assigned")
    per = rows.groupBy("cluster").agg(F.try_sum(F.col("distance").cast("decimal(20,0)")).alias("d"))
    found = {r["cluster"]: int(r["d"]) for r in per.collect()}  # k rows
    fits = lambda n: n if n < 1 << 63 else None
    facts = [(c, fits(d), fits(sum(found.values())), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
             for c, d in sorted(found.items())]
    side = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(side), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
