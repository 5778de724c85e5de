"""Best-fit packing by length histogram (operator 2).

Documents become token pieces of at most ``capacity`` ids. Only the histogram of piece lengths
(at most ``capacity`` rows, whatever the corpus) reaches the driver. Best fit, longest first,
is planned over counts: all sequences with one history form a class, and a length takes whole
classes at a time. The plan is a list of runs: ranks ``lo`` to ``hi`` of one length go to
consecutive sequences, ``per`` of them in each, from one offset on. Pieces then find their
place by a join on length and rank within length.

Ranks need no sort and no group: each task numbers its pieces of a length as it meets them, and
the counts of earlier tasks are added, so a length that a third of all pieces share is no
hot group.

Defined results: a null text is an empty text (one piece with the end id alone); an empty
table gives an empty result; repeated rows are packed as separate documents.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage
from sparkrisk.llm.tokens import encoder

CAPACITY = 4096


def plan_best_fit(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, lo, hi, first sequence, per, offset) that place ``histogram[length]``
    pieces of each length by best fit in order of falling length.

    A length goes to the sequences with the least room that is enough. One that has taken a
    piece and has room for another has the least room of all, so a class of sequences takes
    ``room // length`` pieces each before the next class is looked at.
    """
    rooms: list[int] = []  # sorted rooms that some class has
    classes: dict[int, list[tuple[int, int]]] = {}  # room -> (first sequence, sequences)
    runs, sequences = [], 0

    def add(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in classes:
                classes[room] = []
                insort(rooms, room)
            classes[room].append((first, n))

    for length in sorted(histogram, reverse=True):
        count, rank = histogram[length], 0
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = classes[room].pop()
                if not classes[room]:
                    del classes[room]
                    rooms.pop(at)
            else:  # open as many new sequences as are needed
                room = capacity
                first, n = sequences, -(-count // (room // length))
                sequences += n
            per = room // length
            full = min(n, count // per)
            left = min(per, count - full * per) if full < n else 0
            if full:
                runs.append((length, rank, rank + full * per, first, per, capacity - room))
                add(room - per * length, first, full)
            if left:
                runs.append((length, rank + full * per, rank + full * per + left, first + full, per, capacity - room))
                add(room - left * length, first + full, 1)
            used = full + bool(left)
            add(room, first + used, n - used)
            rank += full * per + left
            count -= full * per + left
    return runs


def token_pieces(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids], part, local_rank): ids of whole texts by
    the library, then ``end_id``, cut every ``capacity`` ids. ``local_rank`` counts the earlier
    pieces of that length in the same task (``part``)."""
    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator) -> Iterator:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc, end, seen = encoder(path), np.array([end_id], "<u4").tobytes(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            rows, pieces, crcs, sizes, ids = [], [], [], [], []
            for i, raw in enumerate(enc.encode_rows(batch.column(1))):
                raw += end
                for p, at in enumerate(range(0, len(raw), 4 * capacity)):
                    cut = raw[at : at + 4 * capacity]
                    rows.append(i)
                    pieces.append(p)
                    sizes.append(len(cut) // 4)
                    crcs.append(zlib.crc32(cut))
                    if with_ids:
                        ids.append(np.frombuffer(cut, "<u4").astype(np.int32))
            ranks = np.empty(len(sizes), dtype=np.int64)
            for i, n in enumerate(sizes):
                ranks[i] = seen[n]
                seen[n] += 1
            piece = np.array(pieces, dtype=np.int32)
            cols = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece),
                    pa.array(piece.astype(np.int64) * capacity), pa.array(sizes, pa.int64()), pa.array(crcs, pa.int64())]
            names = ["key", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            cols += [pa.array(np.full(len(sizes), part, dtype=np.int32)), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, "part", "local_rank"])

    kind = docs.schema[key].dataType.simpleString()
    schema = (f"key {kind}, piece int, start long, length long, ids_crc32 long, "
              + ("ids array<int>, " if with_ids else "") + "part int, local_rank long")
    out = docs.select(docs[key].alias("key"), docs[text].alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("key", key)


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset``. ``pieces`` is read several times and must be a
    written table (ranks within a task must not change between reads)."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(F.col("part").alias("p"), F.col("length").alias("l"),
                         F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # The plan's size depends on the capacity alone, not on the number of pieces.
    runs = spark.createDataFrame(plan_best_fit(histogram, capacity),
                                 "run_length long, lo long, hi long, first long, per long, at long")
    ranked = pieces.join(base, (F.col("part") == F.col("p")) & (F.col("length") == F.col("l")))
    ranked = ranked.withColumn("rank", F.col("local_rank") + F.col("base"))
    on = (F.col("length") == F.col("run_length")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    nth = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(runs), on).withColumns({
        "sequence_id": F.col("first") + F.floor(nth / F.col("per")),
        "offset": F.col("at") + (nth % F.col("per")) * F.col("length"),
    })
    return placed.drop("part", "local_rank", "p", "l", "base", "rank", "run_length", "lo", "hi", "first", "per", "at")


def pack(docs: DataFrame, path: str, end_id: int, capacity: int = CAPACITY, key: str = "doc_id",
         text: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places: (key, piece, start, length, ids_crc32[, ids],
    sequence_id, offset)."""
    return place(stage(token_pieces(docs, path, end_id, capacity, key, text, with_ids), "pieces"), capacity)
