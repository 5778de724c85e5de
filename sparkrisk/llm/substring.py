"""Removal of passages that occurred before, with FM-indexes per shard (operator 7).

A window is ``width`` consecutive words of one document. A word goes if some window covers it
whose word sequence also starts earlier (smaller document, or same document and earlier start).

1. Every window has a minimizer: the least hash among its runs of ``gram`` words. Neighbouring
   windows with the same minimizer form a segment. Equal windows have equal minimizers, so a
   window can only be repeated in segments of the same minimizer. Tasks hash whole Arrow columns
   with numpy and send segments (25 bytes each, packed per receiving partition) by minimizer.
   Equal segments meet in the sending task first: all but its earliest are marked as repeated
   there, so a passage that a third of all documents share is sent once per task.
2. A minimizer with one segment repeats nowhere. Of equal segments, all but the first are
   repeated. Different segments under one minimizer may share windows: these candidates take
   their words from the texts.
3. Candidates are dealt by minimizer to shards. A minimizer with more than ``hot`` different
   segments (say, the border of a passage that very many documents share, each with other words
   around it) would make one shard grow with the corpus: its windows are dealt one by one by a
   hash of their words, after each task has kept the earliest of its equal ones.
   Each shard numbers its words (no hashes from
   here on), builds a compressed FM-index over its segments, and streams the segments through
   backward search: matching statistics up to the threshold ``width`` and their suffix
   intervals, in which the earliest occurrence is found.
4. Intervals of repeated windows meet their document by id, and the words go.

Segments are compared by 128 bits of hash in steps 1 and 2.

Defined results: null and empty texts have no words; texts shorter than ``width`` words lose
nothing; rows with a null id are returned whole and are compared with nothing. Rows with equal
id and text are one document (each is returned, with the same result); rows with equal id and
different texts are different documents, in the order of their text's crc32. Other columns
are ignored or, in ``remove_repeats``, kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import stage
from sparkrisk.llm.fmindex import FmIndex
from sparkrisk.llm.wordhash import Runs, utf8, window_argmin, words

WIDTH = 20
GRAM = 8
# Different segments of one minimizer that go to one shard.
HOT_SEGMENTS = 500
# Windows of hot minimizers that a task compares before it passes them on.
HELD_WINDOWS = 500_000
# Segments a sending task holds before it packs them.
HELD_SEGMENTS = 600_000
# Bytes of text that a sending task hashes at once: several 8-byte numbers are made of every byte.
HASHED_BYTES = 1 << 20
# Symbols of one FM-index.
SHARD_SYMBOLS = 1_500_000
_WORD = re.compile("[^\x20\x09-\x0d]+")
_RECORD = np.dtype([("mh", "<u8"), ("ch", "<u8"), ("row", "<u4"), ("start", "<u4"), ("count", "u1")])


def _segments(column, width: int, gram: int) -> tuple:
    """(minimizer hash, content hash, text index, first window, windows) of every segment."""
    data, offsets = utf8(column)
    word, _, _, per_text = words(data, offsets)
    runs, grams = Runs(word), width - gram + 1
    first = np.cumsum(per_text) - per_text
    windows = np.maximum(per_text - width + 1, 0)
    total = int(windows.sum())
    if not total:
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)
    text = np.repeat(np.arange(len(windows)), windows)
    inside = np.arange(total) - np.repeat(np.cumsum(windows) - windows, windows)
    start = first[text] + inside
    gram_hash = runs.hash(np.arange(len(word) - gram + 1), gram)
    least = window_argmin(gram_hash, grams)[start]
    begin = np.ones(total, dtype=bool)
    begin[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    at = np.nonzero(begin)[0]
    count = np.diff(np.append(at, total))
    content = runs.hash(start[at], count + width - 1)
    return gram_hash[least[at]], content, text[at], inside[at], count


def _slices(column, most: int = HASHED_BYTES) -> Iterator[tuple[int, int]]:
    """(first text, texts) of runs of texts with about ``most`` bytes together, or one longer text."""
    import pyarrow.compute as pc

    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(size):
        z = max(a + 1, int(np.searchsorted(size, (size[a - 1] if a else 0) + most, side="right")))
        yield a, z - a
        a = z


def _first_of_equal(mh, ch, *order) -> tuple[np.ndarray, np.ndarray]:
    """(sorting permutation by content then ``order``, whether each is the first of its content)."""
    by = np.lexsort((*reversed(order), ch, mh))
    new = np.ones(len(by), dtype=bool)
    new[1:] = (mh[by][1:] != mh[by][:-1]) | (ch[by][1:] != ch[by][:-1])
    return by, new


def repeated_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                     hot: int = HOT_SEGMENTS) -> DataFrame:
    """(doc long, mark long, start int, count int): ``count`` windows from word ``start`` on
    that occurred before. ``mark`` is the text's crc32."""
    import pyarrow as pa

    spark = docs.sparkSession
    own = docs.select(docs[key].cast("long").alias("doc"), docs[text].alias("text")).filter("doc is not null")
    own = own.withColumn("mark", F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def send(batches: Iterator) -> Iterator:
        held, docs_, marks, rows, size = [], [], [], 0, 0

        def pack():
            mh, ch, row, start, count = (np.concatenate([h[i] for h in held]) for i in range(5))
            doc, mark = np.concatenate(docs_), np.concatenate(marks)
            by, new = _first_of_equal(mh, ch, doc[row], mark[row], start)
            # Later ones of equal segments are repeated for certain, unless they are the same place.
            head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
            same = (doc[row[by]] == doc[row[by[head]]]) & (mark[row[by]] == mark[row[by[head]]]) & (start[by] == start[by[head]])
            again = by[~new & ~same]
            again = again[np.lexsort((start[again], row[again]))]
            r, s, c = row[again], start[again], count[again]
            cut = np.ones(len(r), dtype=bool)  # neighbours in one document become one interval
            cut[1:] = (r[1:] != r[:-1]) | (s[1:] != s[:-1] + c[:-1])
            at = np.nonzero(cut)[0]
            n = np.add.reduceat(c, at) if len(at) else c
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(at), pa.int32()), pa.nulls(len(at), pa.binary()), pa.nulls(len(at), pa.binary()),
                 pa.array(doc[r[at]]), pa.array(mark[r[at]]), pa.array(s[at].astype(np.int32)), pa.array(n.astype(np.int32))], names=names)
            kept = by[new]
            target = (mh[kept] % np.uint64(parts)).astype(np.int64)
            kept = kept[np.argsort(target, kind="stable")]
            ends = np.cumsum(np.bincount(target, minlength=parts))
            for p, (a, z) in enumerate(zip(ends - np.diff(ends, prepend=0), ends)):
                if a == z:
                    continue
                pick = kept[a:z]
                used, row_of = np.unique(row[pick], return_inverse=True)
                body = b"".join([mh[pick].tobytes(), ch[pick].tobytes(), row_of.astype("<u4").tobytes(),
                                 start[pick].astype("<u4").tobytes(), count[pick].astype("u1").tobytes()])
                table = np.stack([doc[used], mark[used]]).astype("<i8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([body]), pa.array([table]),
                                                  *[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int32())]], names=names)

        names = ["part", "body", "docs", "doc", "mark", "start", "count"]
        for batch in batches:
            for first, n in _slices(batch.column(1)):
                mh, ch, row, start, count = _segments(batch.column(1).slice(first, n), width, gram)
                held.append((mh, ch, row + rows + first, start, count))
                size += len(mh)
            docs_.append(batch.column(0).to_numpy())
            marks.append(batch.column(2).to_numpy())
            rows += batch.num_rows
            if size >= HELD_SEGMENTS:
                yield from pack()
                held, docs_, marks, rows, size = [], [], [], 0, 0
        if held:
            yield from pack()

    def meet(batches: Iterator) -> Iterator:
        mh, ch, doc, mark, start, count = ([] for _ in range(6))
        for batch in batches:
            for body, table in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                n = len(body) // _RECORD.itemsize
                mh.append(np.frombuffer(body, "<u8", n))
                ch.append(np.frombuffer(body, "<u8", n, 8 * n))
                row = np.frombuffer(body, "<u4", n, 16 * n)
                start.append(np.frombuffer(body, "<u4", n, 20 * n).astype(np.int32))
                count.append(np.frombuffer(body, "u1", n, 24 * n).astype(np.int32))
                both = np.frombuffer(table, "<i8").reshape(2, -1)
                doc.append(both[0][row])
                mark.append(both[1][row])
        if not mh:
            return
        mh, ch, doc, mark, start, count = map(np.concatenate, (mh, ch, doc, mark, start, count))
        by = np.argsort(mh, kind="stable")
        equal = mh[by][1:] == mh[by][:-1]
        more = np.zeros(len(by), dtype=bool)
        more[1:] |= equal
        more[:-1] |= equal
        pick = by[more]  # segments whose minimizer occurs again
        mh, ch, doc, mark, start, count = (a[pick] for a in (mh, ch, doc, mark, start, count))
        by, new = _first_of_equal(mh, ch, doc, mark, start)
        mh, doc, mark, start, count = (a[by] for a in (mh, doc, mark, start, count))
        head = np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
        same = (doc == doc[head]) & (mark == mark[head]) & (start == start[head])
        again = np.nonzero(~new & ~same)[0]
        # Minimizers with different segments: the first of each is a candidate. (Two windows of
        # one segment have their minimizer at different places, so they are never equal.)
        first = np.nonzero(new)[0]
        alike = mh[first][1:] == mh[first][:-1]
        several = np.zeros(len(first), dtype=bool)
        several[1:] |= alike
        several[:-1] |= alike
        first = first[several]
        _, which, size = np.unique(mh[first], return_inverse=True, return_counts=True)
        many = size[which] > hot
        for pick, group in ((again, None), (first, mh[first].view(np.int64))):
            for a in range(0, len(pick), 100_000):
                i = pick[a : a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(i), pa.int64()) if group is None else pa.array(group[a : a + 100_000]), pa.array(doc[i]),
                     pa.array(mark[i]), pa.array(start[i]), pa.array(count[i]),
                     pa.nulls(len(i), pa.bool_()) if group is None else pa.array(many[a : a + 100_000])],
                    names=["mh", "doc", "mark", "start", "count", "hot"])

    sent = stage(own.select("doc", "text", "mark").mapInArrow(
        send, "part int, body binary, docs binary, doc long, mark long, start int, count int"), "segments")
    met = sent.filter("part is not null").select("part", "body", "docs").repartitionById(parts, F.col("part")).mapInArrow(
        meet, "mh long, doc long, mark long, start int, count int, hot boolean")
    met = stage(met, "candidates")
    known = sent.filter("doc is not null").select("doc", "mark", "start", "count").unionByName(
        met.filter("mh is null").select("doc", "mark", "start", "count"))

    # Candidates with their words, by minimizer.
    asked = met.filter("mh is not null").groupBy("doc", "mark").agg(F.collect_list(F.struct("mh", "start", "count", "hot")).alias("asked"))
    asked = asked.select(F.col("doc").alias("d"), F.col("mark").alias("m"), "asked")
    texts = own.join(asked.hint("shuffle_hash"), (F.col("doc") == F.col("d")) & (F.col("mark") == F.col("m")))

    def cut(batches: Iterator) -> Iterator:
        earliest: dict[str, tuple] = {}  # of windows of hot minimizers, in this task

        def rows(out: list) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)],
                                              names=["mh", "doc", "mark", "start", "words"])

        def passed_on() -> pa.RecordBatch:
            key = lambda x: int.from_bytes(hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
            out = [(key(x), *place, x) for x, place in earliest.items()]
            earliest.clear()
            return rows(out)

        for batch in batches:
            out = []
            for doc, mark, text_, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                w = _WORD.findall(text_ or "")
                for a in wanted:
                    s, n = a["start"], a["count"]
                    if not a["hot"]:
                        out.append((a["mh"], doc, mark, s, " ".join(w[s : s + n + width - 1])))
                        continue
                    for i in range(s, s + n):
                        window, here = " ".join(w[i : i + width]), (doc, mark, i)
                        there = earliest.setdefault(window, here)
                        if here != there:  # the later one is repeated for certain
                            earliest[window] = min(here, there)
                            out.append((None, *max(here, there), None))
            yield rows(out)
            if len(earliest) >= HELD_WINDOWS:
                yield passed_on()
        if earliest:
            yield passed_on()

    def search(batches: Iterator) -> Iterator:
        held, symbols, last = [], 0, None
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for row in rows:
                if symbols >= SHARD_SYMBOLS and row[0] != last:  # a shard holds all segments of its minimizers
                    yield from _repeats_in_shard(held, width)
                    held, symbols = [], 0
                held.append(row)
                symbols += row[4].count(" ") + 2
                last = row[0]
        if held:
            yield from _repeats_in_shard(held, width)

    segments = texts.select("doc", "mark", "text", "asked").mapInArrow(cut, "mh long, doc long, mark long, start int, words string")
    segments = stage(segments, "windows")
    known = known.unionByName(segments.filter("mh is null").select("doc", "mark", "start", F.lit(1).alias("count")))
    segments = segments.filter("mh is not null").repartition(parts, "mh").sortWithinPartitions("mh", "doc", "mark", "start")
    found = segments.mapInArrow(search, "doc long, mark long, start int, count int")
    return known.unionByName(found)


def _repeats_in_shard(rows: list[tuple], width: int) -> Iterator:
    """Windows of the shard's segments that the shard holds at an earlier place."""
    import pyarrow as pa

    rows = sorted(set(rows), key=lambda r: r[1:4])
    number: dict[str, int] = {}
    text: list[int] = []
    for _, doc, mark, start, line in rows:
        w = line.split(" ")
        text += [number.setdefault(x, len(number) + 1) for x in w]
        text.append(0)
    sizes = np.array([r[4].count(" ") + 1 for r in rows], dtype=np.int64)
    text = np.array(text, dtype=np.int64)
    base = np.cumsum(sizes + 1) - (sizes + 1)
    doc, mark, start = (np.array([r[i] for r in rows], dtype=np.int64) for i in (1, 2, 3))
    segment = np.repeat(np.arange(len(rows)), sizes + 1)
    word = np.arange(len(text)) - base[segment] + start[segment]
    # Rank of every word's place (document, word number); equal places share a rank.
    order = np.lexsort((word, mark[segment], doc[segment]))
    sorted_ = (doc[segment][order], mark[segment][order], word[order])
    step = np.zeros(len(order), dtype=np.int64)
    step[1:] = np.cumsum(np.any([a[1:] != a[:-1] for a in sorted_], axis=0))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = step
    index = FmIndex(text, width)
    windows = sizes - width + 1
    begin = np.repeat(base, windows) + np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
    length, low, high = index.matching_statistics(text, begin + width, width)
    full = np.nonzero(length >= width)[0]
    if not len(full):
        return
    low, high, begin = low[full], high[full], begin[full]
    intervals, which = np.unique(low, return_inverse=True)
    ends = np.empty(len(intervals), dtype=np.int64)
    ends[which] = high
    by_suffix = np.append(place[index.order], 0)
    earliest = np.minimum.reduceat(by_suffix, np.stack([intervals, ends], 1).ravel())[::2]
    again = begin[earliest[which] < place[begin]]
    if not len(again):
        return
    cut = np.ones(len(again), dtype=bool)
    cut[1:] = (again[1:] != again[:-1] + 1) | (segment[again][1:] != segment[again][:-1])
    at = np.nonzero(cut)[0]
    n = np.diff(np.append(at, len(again)))
    s = segment[again[at]]
    yield pa.RecordBatch.from_arrays([pa.array(doc[s]), pa.array(mark[s]), pa.array(word[again[at]].astype(np.int32)),
                                      pa.array(n.astype(np.int32))], names=["doc", "mark", "start", "count"])


def _with_windows(docs: DataFrame, key: str, text: str, width: int, gram: int, hot: int) -> DataFrame:
    """All columns of ``docs`` and ``__windows``: array of (start, count), null if none."""
    found = repeated_windows(docs, key, text, width, gram, hot)
    by_doc = found.groupBy("doc", "mark").agg(F.collect_list(F.struct("start", "count")).alias("__windows"))
    by_doc = by_doc.select(F.col("doc").alias("__doc"), F.col("mark").alias("__mark"), "__windows")
    on = (docs[key].cast("long") == F.col("__doc")) & (F.coalesce(F.crc32(docs[text].cast("binary")), F.lit(0)) == F.col("__mark"))
    return docs.join(by_doc.hint("shuffle_hash"), on, "left").drop("__doc", "__mark")


def _removed(n: int, windows, width: int) -> np.ndarray:
    """Which of ``n`` words some repeated window covers."""
    change = np.zeros(n + 1, dtype=np.int64)
    for w in windows or ():
        change[w["start"]] += 1
        change[min(n, w["start"] + w["count"] + width - 1)] -= 1
    return np.cumsum(change)[:n] > 0


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                   hot: int = HOT_SEGMENTS) -> DataFrame:
    """All columns of ``docs``; in ``text`` the repeated words are gone, with the white space
    after each. A null text stays null."""
    import pyarrow as pa
    from pyspark.sql import types as T

    schema = T.StructType([f for f in docs.schema.fields])
    at = docs.columns.index(text)

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            out = []
            for t, windows in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if t and windows:
                    spans = [m.span() for m in _WORD.finditer(t)]
                    gone = _removed(len(spans), windows, width)
                    ends = [s for s, _ in spans[1:]] + [len(t)]
                    t = (t[: spans[0][0]] + "".join(t[s:e] for (s, _), e, g in zip(spans, ends, gone.tolist()) if not g)).rstrip() \
                        if gone.any() else t
                out.append(t)
            cols = batch.columns[:-1]
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return _with_windows(docs, key, text, width, gram, hot).select(*docs.columns, "__windows").mapInArrow(run, schema)


def kept_digests(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM,
                 hot: int = HOT_SEGMENTS) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256): the kept words joined by one space, digested."""
    import pyarrow as pa

    own = docs.select(docs[key].alias(key), docs[text].alias(text))
    kind = own.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            n, removed, sha = [], [], []
            for t, windows in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                w = _WORD.findall(t or "")
                n.append(len(w))
                if windows:
                    gone = _removed(len(w), windows, width)
                    w = [x for x, g in zip(w, gone.tolist()) if not g]
                removed.append(n[-1] - len(w))
                sha.append(hashlib.sha256(" ".join(w).encode("utf-8", "replace")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha)],
                                             names=["key", "n_words", "n_removed", "kept_sha256"])

    out = _with_windows(own, key, text, width, gram, hot).mapInArrow(run, f"key {kind}, n_words long, n_removed long, kept_sha256 string")
    return out.withColumnRenamed("key", key)
