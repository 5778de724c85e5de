"""Token ids in bit-packed files (operator 10).

A file holds blocks in key order. A block is one row of a Parquet container (so any store that
Spark reads will do): the keys and lengths of its documents, and a payload in which every id
takes exactly ``bits`` bits, the least that hold the largest id of the vocabulary. Id ``i`` of
a block starts at bit ``i * bits``, so a document is reached by arithmetic, without reading the
ids before it, and a whole block is unpacked by a few numpy operations.

Writing: documents are range-partitioned and sorted by key (and then a hash of the text, so that one
key may be several ranges); a task writes one shard, whose number follows the key order. Ids before a shard are the sums of the shards before it.

Defined results: a null text is an empty text (the end id alone); repeated keys are separate
documents next to each other, in the order of a hash of their texts; an empty table gives files without blocks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkrisk.llm.tokens import encoder

# Ids in a block, at least (a document is never split).
BLOCK_IDS = 1 << 17


def bits_for(size: int) -> int:
    """The least number of bits that hold ids below ``size``."""
    return max(1, (size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` one after the other, ``bits`` bits each, lowest bit first, in 64-bit words."""
    n = len(ids)
    if not n:
        return b""
    first = np.arange(n, dtype=np.int64) * bits
    word, off = first >> 6, (first & 63).astype(np.uint64)
    value = ids.astype(np.uint64)
    out = np.zeros((n * bits + 63) // 64 + 1, dtype="<u8")
    starts = np.nonzero(np.diff(word, prepend=-1))[0]
    out[word[starts]] = np.bitwise_or.reduceat(value << off, starts)
    over = np.nonzero((off + np.uint64(bits)) > 64)[0]  # at most one id crosses each word's end
    out[word[over] + 1] |= value[over] >> (np.uint64(64) - off[over])
    return out[: (n * bits + 63) // 64].tobytes()


def unpack_bits(payload: bytes, bits: int, start: int, count: int) -> np.ndarray:
    """Ids ``start`` to ``start + count`` of a payload, without reading the others."""
    first = (np.arange(start, start + count, dtype=np.int64)) * bits
    words = np.frombuffer(payload, dtype="<u8")
    word, off = first >> 6, (first & 63).astype(np.uint64)
    value = words[word] >> off
    over = np.nonzero((off + np.uint64(bits)) > 64)[0]
    value[over] |= words[word[over] + 1] << (np.uint64(64) - off[over])
    return (value & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, key: str = "doc_id",
                      text: str = "text", block_ids: int = BLOCK_IDS) -> str:
    """Encode whole texts, append ``end_id`` to each, write blocks under ``path``."""
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        shard, enc, end = TaskContext.get().partitionId(), encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        bits = bits_for(max(enc.size, end_id + 1))
        keys: list = []
        sizes: list[int] = []
        held: list[bytes] = []
        total, block, before = 0, 0, 0

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([bits], pa.int32()), pa.array([keys], pa.list_(key_type)), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([pack_bits(ids, bits)], pa.binary())],
                names=["shard", "block", "before", "bits", "keys", "lengths", "payload"])

        for batch in batches:
            key_type = batch.column(0).type
            for k, raw in zip(batch.column(0).to_pylist(), enc.encode_rows(batch.column(1))):
                held.append(raw + end)
                keys.append(k)
                sizes.append(len(raw) // 4 + 1)
                total += sizes[-1]
                if total >= block_ids:
                    yield flush()
                    block, before = block + 1, before + total
                    keys, sizes, held, total = [], [], [], 0
        if held:
            yield flush()

    kind = docs.schema[key].dataType.simpleString()
    # Rows of one id are dealt by a hash of their texts, equal rows by where they stand (they are alike
    # in the files), so an id that holds many rows is many ranges.
    own = docs.select(docs[key].alias("key"), docs[text].alias("text"), F.xxhash64(docs[text]).alias("mark"),
                      F.monotonically_increasing_id().alias("row"))
    own = own.repartitionByRange("key", "mark", "row").sortWithinPartitions("key", "mark", "text").select("key", "text")
    own.mapInArrow(run, f"shard int, block int, before long, bits int, keys array<{kind}>, "
                        "lengths array<long>, payload binary").write.parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document, from the files."""
    import pyarrow as pa

    blocks = spark.read.parquet(path)
    # One row per shard (task that wrote): ids before each.
    shards = blocks.groupBy(F.col("shard").alias("s")).agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    w = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("s", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("base"))
    based = blocks.join(F.broadcast(shards), F.col("shard") == F.col("s")).select(
        (F.col("base") + F.col("before")).alias("start"), "bits", "keys", "lengths", "payload")

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for i in range(batch.num_rows):
                start, bits, payload = (batch.column(j)[i].as_py() for j in (0, 1, 4))
                keys, lengths = batch.column(2)[i].values, batch.column(3)[i].values.to_numpy()
                at = np.cumsum(lengths) - lengths
                ids = unpack_bits(payload, bits, 0, int(lengths.sum())).astype("<u4")
                view = memoryview(ids.tobytes())
                crcs = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), lengths.tolist())]
                cols = [keys, pa.array(at + start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(np.split(ids.astype(np.int32), at[1:]), pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    out = based.mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("key", key)
