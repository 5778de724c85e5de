"""Approximate nearest neighbours by shifted space-filling curves (operator 1).

Each of several orderings projects the vectors to a few random directions, shifts them, and
sorts them along the Hilbert curve of that small space. Spark range-partitions the curve keys;
ranks along the curve cut every ordering into blocks of ``block_rows`` neighbours, or of a quarter of the
window's half in a large table. A query goes
to the blocks within ``window`` (a share of the table) around its own place, is compared there
with the original vectors in double precision, and the best of all orderings are merged.

Vectors without neighbourhood structure (independent directions) need wide windows: the
defaults reach a recall above 0.95 on such tables and then look at more pairs than one full
scan would; on clustered vectors a much smaller ``window`` does (see the README).

Identical vectors are one entry with its smallest ids, as many as a result can hold, so a vector
that a third of all rows share is one row of the index.

Defined results: null, empty and all-zero vectors, vectors with a null or non-finite component,
and rows without an id take no part, as query or candidate; so do vectors whose length is not
the table's most frequent one. Ties go to the smaller id. Repeated ids are one candidate each
score. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage

ORDERINGS = 8
DIMENSIONS = 4
BITS = 12
WINDOW = 0.2
BLOCK_ROWS = 2048
# Most numbers of a block that is larger than BLOCK_ROWS, and scores held at a time.
BLOCK_VALUES = 1 << 22
SCORES = 1 << 22
# Scores of which only the greatest is looked at first.
GROUP = 16


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of grid cells (``n x d`` integers below
    ``2**bits``, ``d * bits`` at most 62): Gray-code axes to transposed index, bits interleaved."""
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        q = 1 << bit
        low = q - 1
        for i in range(d):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        carry ^= np.where((x[d - 1] >> bit) & 1, (1 << bit) - 1, 0)
    x ^= carry
    key = np.zeros_like(carry)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equally long vectors as a float64 matrix."""
    values = column.values.slice(column.offsets[0].as_py(), column.offsets[-1].as_py() - column.offsets[0].as_py())
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _projections(dim: int, orderings: int, dimensions: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = np.concatenate([np.linalg.qr(rng.normal(size=(dim, max(dim, dimensions))).T)[0][:dimensions, :] if dim < dimensions
                        else np.linalg.qr(rng.normal(size=(dim, dim)))[0][:dimensions] for _ in range(orderings)])
    return p.T, rng.random(orderings * dimensions)


def _best(queries: np.ndarray, own: np.ndarray, base: np.ndarray, longest: float, ids: np.ndarray, sizes: np.ndarray,
          k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best entries of a block for each query, itself excluded: how many, and one after the other
    the negative scores and ids. ``sizes`` has the number of ``ids`` of every entry, ``longest`` the norm of
    the longest entry."""
    score = queries @ base.T
    take = min(k + 1, len(base))
    # The greatest of each of many groups: the least of the best of those is no more than that of all.
    groups = len(base) // GROUP
    bound = score[:, : groups * GROUP].reshape(len(score), GROUP, groups).max(1) if groups >= 4 * take else score
    least = np.partition(bound, bound.shape[1] - take, axis=1)[:, bound.shape[1] - take]
    # The product of matrices and the product of a pair may differ in their last bits.
    slack = 1e-12 * np.maximum(1.0, np.linalg.norm(queries, axis=1) * longest)
    row, entry = np.divmod(np.flatnonzero(score >= (least - slack)[:, None]), len(base))
    d = -np.vecdot(queries[row], base[entry])
    # One candidate for each id of an entry.
    many = sizes[entry]
    first = (np.cumsum(sizes) - sizes)[entry]
    row, d = np.repeat(row, many), np.repeat(d, many)
    x = ids[np.repeat(first - (np.cumsum(many) - many), many) + np.arange(len(row))]
    other = x != own[row]
    row, d, x = row[other], d[other], x[other]
    order = np.lexsort((x, d, row))
    row, d, x = row[order], d[order], x[order]
    n = np.bincount(row, minlength=len(queries))
    kept = np.arange(len(row)) - (np.cumsum(n) - n)[row] < k
    return np.minimum(n, k), d[kept], x[kept]


def nearest(vectors: DataFrame, k: int = 20, query: Column | None = None, key: str = "vec_id", vector: str = "embedding",
            orderings: int = ORDERINGS, dimensions: int = DIMENSIONS, bits: int = BITS, window: float = WINDOW,
            block_rows: int = BLOCK_ROWS, seed: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that meets ``query`` (all rows, if None) its
    ``k`` nearest found by largest inner product, itself excluded."""
    import pyarrow as pa

    spark = vectors.sparkSession
    rows = vectors.select(vectors[key].cast("long").alias("id"), vectors[vector].alias("v"),
                          (F.lit(True) if query is None else F.coalesce(query, F.lit(False))).alias("q"))
    rows = rows.filter(F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], result)
    dim, total = sizes[0]["d"], sizes[0]["n"]
    dimensions = min(dimensions, dim)
    bits = min(bits, 62 // dimensions)
    rows = rows.filter(F.size("v") == dim)

    # One entry per distinct vector, with its k + 1 smallest ids (a result never needs more; the
    # rank filter is applied before the shuffle, so a frequent vector arrives as a few rows a task).
    smallest = Window.partitionBy("v").orderBy("id")
    few = rows.select("id", "v").withColumn("nth", F.row_number().over(smallest)).filter(F.col("nth") <= k + 1)
    entries = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    nodes = stage(entries.select(F.lit(False).alias("q"), F.col("ids")[0].alias("id"), "ids", "v").unionByName(
        rows.filter("q").select(F.lit(True).alias("q"), "id", F.array("id").alias("ids"), "v")), "vectors")

    # Mean and spread of every projection: one row of sums per Arrow batch, added up.
    project, shift = _projections(dim, orderings, dimensions, seed)

    def sums(batches: Iterator) -> Iterator:
        for b in batches:
            p = _matrix(b.column(0)) @ project
            yield pa.RecordBatch.from_arrays([pa.array([[len(p)] + p.sum(0).tolist() + (p * p).sum(0).tolist()])], names=["s"])

    n = 1 + 2 * orderings * dimensions
    s = nodes.select("v").mapInArrow(sums, "s array<double>").agg(*[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(n)]).first()
    m = orderings * dimensions
    mean = np.array(s[1 : 1 + m]) / s[0]
    spread = np.sqrt(np.maximum(np.array(s[1 + m :]) / s[0] - mean * mean, 1e-30))

    def curve(batches: Iterator) -> Iterator:
        for b in batches:
            z = (_matrix(b.column(2)) @ project - mean) / spread
            # A logistic squash spreads roughly normal projections evenly; the shift moves the grid.
            u = (1 / (1 + np.exp(-1.702 * z)) + shift) / 2
            cells = np.minimum((u * (1 << bits)).astype(np.int64), (1 << bits) - 1)
            keys = np.stack([hilbert_keys(cells[:, o * dimensions : (o + 1) * dimensions], bits) for o in range(orderings)], 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(keys), pa.list_(pa.int64()))],
                                             names=["q", "id", "keys"])

    keyed = nodes.select("q", "id", "v").mapInArrow(curve, "q boolean, id long, keys array<long>")
    keyed = keyed.select("q", "id", F.posexplode("keys").alias("o", "key"))
    # Ranks along each curve: place within the range partition plus what lies before it.
    order = ["o", "key", "id", "q"]
    sorted_ = stage(keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(
        "place", F.monotonically_increasing_id()), "curve")
    sorted_ = sorted_.withColumn("part", F.shiftright("place", 33))
    counts = sorted_.groupBy("o", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("o").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("o").alias("co"), F.col("part").alias("cp"), "first",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = sorted_.join(counts, (F.col("o") == F.col("co")) & (F.col("part") == F.col("cp"))).select(
        "o", "q", "id", (F.col("place") - F.col("first") + F.col("base")).alias("at"))
    width = max(1, int(window * total / 2))
    # A query moves once for every block of its window: in a large table blocks grow with the window.
    block_rows = max(block_rows, min(width // 4, BLOCK_VALUES // dim))
    width = F.lit(width)
    block = lambda c: F.greatest(F.floor(c / block_rows), F.lit(0)).cast("int")
    span = F.sequence(block(F.col("at") - width), block(F.col("at") + width))
    places = ranked.select("q", "id", "o", F.explode(F.when(F.col("q"), span).otherwise(F.array(block(F.col("at"))))).alias("block"))
    # Their number is given: adaptive execution would merge tasks by their bytes, of which the search has few.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work = places.join(nodes, ["q", "id"]).repartition(tasks, "o", "block").sortWithinPartitions("o", "block", "q", "id")

    def search(batches: Iterator) -> Iterator:
        here, known, lists, block_of = None, [], [], None
        for b in batches:
            o, blocks, is_query = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 2))
            vecs, id_lists = _matrix(b.column(4)), b.column(3)
            code = o.astype(np.int64) << 40 | blocks
            cuts = [0, *(np.nonzero((np.diff(code) != 0) | (np.diff(is_query.astype(np.int8)) != 0))[0] + 1).tolist(), len(o)]
            for a, z in zip(cuts[:-1], cuts[1:]):
                if a == z:
                    continue
                if here != code[a]:
                    here, known, lists, block_of = code[a], [], [], None
                if not is_query[a]:
                    known.append(vecs[a:z])
                    lists.append(id_lists.slice(a, z - a))
                    block_of = None
                    continue
                if not known:
                    continue
                if block_of is None:
                    base, every = np.concatenate(known), pa.concat_arrays(lists)
                    known, lists = [base], [every]
                    block_of = (base, np.linalg.norm(base, axis=1).max(), every.flatten().to_numpy(), np.diff(every.offsets.to_numpy()))
                own = id_lists.slice(a, z - a).flatten().to_numpy()
                step = max(1, SCORES // len(block_of[0]))
                for i in range(0, z - a, step):
                    n, d, x = _best(vecs[a + i : min(a + i + step, z)], own[i : i + step], *block_of, k)
                    some = n > 0
                    if some.any():
                        near = pa.StructArray.from_arrays([pa.array(d), pa.array(x)], names=["d", "id"])
                        ends = pa.array(np.concatenate([[0], np.cumsum(n[some])]), pa.int32())
                        yield pa.RecordBatch.from_arrays([pa.array(own[i : i + step][some]), pa.ListArray.from_arrays(ends, near)],
                                                         names=["query_id", "near"])

    found = work.select("o", "block", "q", "ids", "v").mapInArrow(search, "query_id long, near array<struct<d:double,id:long>>")
    # Sorted first: equal entries then stand side by side, and are not looked for in the whole list.
    best = found.groupBy("query_id").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    differs = lambda x, i: (i == 0) | (x != F.get("near", i - 1))
    best = best.select("query_id", F.posexplode(F.slice(F.filter("near", differs), 1, k)).alias("pos", "n"))
    return best.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("n.id").alias("vec_id"),
                       (-F.col("n.d")).alias("score"))
