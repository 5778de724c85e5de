"""Per-row text work on Arrow columns: dictionary lookup and window counts (T4, T5, T8), word vectors.

A text's words never leave its row: whole batches are split, looked up and counted as columns, so
there is no explode, no join and no regrouping, and rows with equal keys stay apart. Batches are
taken ``ROWS`` texts at a time, which bounds what a task holds.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from sparkrisk.functions.scalar import WHITESPACE

ROWS = 500
# Bytes of text that are worked on at a time where words are counted over several texts, and that share one
# copy of their words' vectors.
CHUNK = 4 << 20


def _slices(batches: Iterator) -> Iterator:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _lists(column) -> tuple[np.ndarray, pa.Array]:
    """(ends, values) of a list column, from 0 on; null lists are empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.append(0, np.cumsum(sizes)), pc.list_flatten(column)


def _words(column) -> tuple[np.ndarray, pa.Array]:
    """(ends, words) of a text column: split on white space; empty pieces are still there."""
    return _lists(pc.split_pattern_regex(pc.fill_null(column, ""), WHITESPACE))


def _kept(ends: np.ndarray, keep: np.ndarray) -> np.ndarray:
    """The ends of lists of which only the values marked by ``keep`` stay."""
    return np.append(0, np.cumsum(keep))[ends]


def _list_array(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)


def lookup_ids(df: DataFrame, vocab: pa.Table, text: str, key: str) -> DataFrame:
    """(key, ids): the ids of the known words of every text, in text order."""
    known, ids = vocab.column("word").combine_chunks(), vocab.column("id").combine_chunks().cast(pa.int32())

    def run(batches: Iterator) -> Iterator:
        for b in _slices(batches):
            ends, words = _words(b.column(1))
            at = pc.index_in(words, value_set=known)
            lists = _list_array(_kept(ends, pc.is_valid(at).to_numpy(zero_copy_only=False)), ids.take(at.drop_null()))
            yield pa.RecordBatch.from_arrays([b.column(0), lists], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key], df[text]).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def lookup_words(df: DataFrame, vocab: pa.Table, ids: str, key: str) -> DataFrame:
    """(key, text): the words of the known ids of every row, joined by one space."""
    words, known = vocab.column("word").combine_chunks(), vocab.column("id").combine_chunks().cast(pa.int32())

    def run(batches: Iterator) -> Iterator:
        for b in _slices(batches):
            ends, values = _lists(b.column(1))
            at = pc.index_in(values.cast(pa.int32()), value_set=known)
            lists = _list_array(_kept(ends, pc.is_valid(at).to_numpy(zero_copy_only=False)), words.take(at.drop_null()))
            yield pa.RecordBatch.from_arrays([b.column(0), pc.binary_join(lists, " ")], names=[key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key], df[ids]).mapInArrow(run, f"`{key}` {kind}, text string")


def _runs(codes: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, count) of every different window of ``n`` codes of every row."""
    windows = np.maximum(np.diff(ends) - n + 1, 0)
    row = np.repeat(np.arange(len(windows)), windows)
    stop = np.cumsum(windows)
    place = np.arange(len(row)) + np.repeat(ends[:-1] - stop + windows, windows)
    base = int(codes.max(initial=0)) + 1
    value, top = row.astype(np.int64), max(len(windows), 1)
    for j in range(n):
        if top * base >= 1 << 62:  # number what there is, in order, before the next word is added
            value = np.unique(value, return_inverse=True)[1]
            top = len(value) + 1
        value, top = value * base + codes[place + j], top * base
    _, first, count = np.unique(value, return_index=True, return_counts=True)
    return row[first], place[first], count


def window_counts(df: DataFrame, text: str, key: str, n: int) -> DataFrame:
    """(key, ngram, count) of the windows of ``n`` words of every row."""
    def run(batches: Iterator) -> Iterator:
        for b in _slices(batches):
            ends, words = _words(b.column(1))
            some = pc.not_equal(words, "")
            ends, words = _kept(ends, some.to_numpy(zero_copy_only=False)), words.filter(some)
            codes = pc.dictionary_encode(words).indices.to_numpy(zero_copy_only=False).astype(np.int64)
            row, first, count = _runs(codes, ends, n)
            parts = [words.take(pa.array(first + j)) for j in range(n)]
            grams = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), grams, pa.array(count.astype(np.int64))],
                                             names=[key, "ngram", "count"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(df[key], df[text]).mapInArrow(run, f"`{key}` {kind}, ngram string, count long")


def _chunks(batches: Iterator, column: int, size: int) -> Iterator:
    """The rows in record batches of about ``size`` bytes of text; a longer text stands alone."""
    held, n = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        at = 0
        for i, b in enumerate(sizes.tolist()):
            if n + b > size and (held or i > at):
                yield _one([*held, batch.slice(at, i - at)])
                held, n, at = [], 0, i
            n += b
        held.append(batch.slice(at))
    if held:
        yield _one(held)


def _one(parts: list) -> pa.RecordBatch:
    return pa.Table.from_batches(parts).combine_chunks().to_batches(max_chunksize=None)[0] if sum(map(len, parts)) else parts[0]


def _coded(column) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(ends, different words, code of every word) of a text column, empty pieces left out."""
    ends, words = _words(column)
    some = pc.not_equal(words, "")
    ends, coded = _kept(ends, some.to_numpy(zero_copy_only=False)), pc.dictionary_encode(words.filter(some))
    return ends, coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def neighbour_bits(df: DataFrame, text: str, neighbours: int, dim: int) -> DataFrame:
    """(word, n, b0 ..): for each different word of a chunk of texts the number of its neighbours (``neighbours``
    on each side) and how many of them have bit d of the first 32 bits of their MD5 set. A word has a row a chunk."""
    if not 0 < 2 * neighbours < 256 or not 0 < dim <= 32:
        raise ValueError("at most 127 neighbours on each side and 32 bits")

    def run(batches: Iterator) -> Iterator:
        for b in _chunks(batches, 0, CHUNK):
            ends, words, codes = _coded(b.column(0))
            if not len(codes):
                continue
            hashes = np.frombuffer(b"".join(hashlib.md5(w.as_buffer()).digest()[:4] for w in words), dtype=">u4")
            bits = np.unpackbits(hashes.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :dim]
            own, row = bits[codes], np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            near, n = np.zeros_like(own), np.zeros(len(codes), np.int64)
            for j in range(1, min(neighbours, len(codes) - 1) + 1):
                same = row[j:] == row[:-j]
                near[j:] += own[:-j] * same[:, None]
                near[:-j] += own[j:] * same[:, None]
                n[j:] += same
                n[:-j] += same
            order = np.argsort(codes, kind="stable")
            start = np.append(0, np.cumsum(np.bincount(codes, minlength=len(words)))[:-1])
            near = near[order]
            sums = [np.add.reduceat(near[:, d], start, dtype=np.int64) for d in range(dim)]
            yield pa.RecordBatch.from_arrays([words, *map(pa.array, [np.add.reduceat(n[order], start), *sums])],
                                             names=["word", "n", *(f"b{d}" for d in range(dim))])

    return df.select(df[text]).mapInArrow(run, f"word string, n long, {', '.join(f'b{d} long' for d in range(dim))}")


def word_counts(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row a text: its ``keys``, chunk, n_words, and codes and counts of its different words. The first text of
    a chunk holds the chunk's ``words``, of which the codes are the places. Write it once before it is used: the
    names of chunks differ from run to run."""
    def run(batches: Iterator) -> Iterator:
        for b in _chunks(batches, len(keys), CHUNK):
            if not b.num_rows:
                continue
            ends, words, codes = _coded(b.column(len(keys)))
            row, first, count = _runs(codes, ends, 1)
            to = np.append(0, np.cumsum(np.bincount(row, minlength=b.num_rows)))
            held = pa.ListArray.from_arrays(pa.array([0] + [len(words)] * b.num_rows, pa.int32()), words)  # the others: none
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keys)], pa.array([uuid.uuid4().hex] * b.num_rows), pa.array(np.diff(ends)),
                 _list_array(to, pa.array(codes[first].astype(np.int32))), _list_array(to, pa.array(count.astype(np.int64))), held],
                names=[*keys, "chunk", "n_words", "codes", "counts", "words"])

    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)
    return df.select(*[df[k] for k in keys], df[text]).mapInArrow(
        run, f"{kinds}, chunk string, n_words long, codes array<int>, counts array<long>, words array<string>")


def mean_vectors(counts: DataFrame, vectors: DataFrame, keys: list[str], dim: int, unit: int) -> DataFrame:
    """(keys, n_words, embedding): the mean of the vectors of a text's words, from rows of ``word_counts`` and
    (asked: a chunk, code, v0 ..) of the words that have one. A task holds one chunk and its words' vectors at a time."""
    def run(texts: pa.Table, known: pa.Table) -> pa.Table:
        at = known.column("code").to_numpy()
        ends, codes = _lists(texts.column("codes").combine_chunks())
        times = _lists(texts.column("counts").combine_chunks())[1].to_numpy()
        codes = codes.to_numpy()
        top = 1 + max(codes.max(initial=0), at.max(initial=0))
        some = np.diff(ends) > 0
        out = np.zeros((len(some), dim))

        def total(values):  # sums over the words of every text that has any
            by_code = np.zeros(top, np.int64)
            by_code[at] = values
            return np.add.reduceat(by_code[codes] * times, ends[:-1][some]) if some.any() else np.zeros(0, np.int64)

        n = total(1)
        for d in range(dim):
            out[some, d] = np.where(n > 0, total(known.column(f"v{d}").to_numpy()) / np.maximum(n, 1) / float(unit), 0.0)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * dim), pa.array(out.ravel()))
        return pa.Table.from_arrays([*(texts.column(k) for k in keys), texts.column("n_words"), lists], names=[*keys, "n_words", "embedding"])

    kinds = ", ".join(f"`{k}` {counts.schema[k].dataType.simpleString()}" for k in keys)
    texts = counts.select(*keys, "chunk", "n_words", "codes", "counts")
    return texts.groupBy("chunk").cogroup(vectors.groupBy("asked")).applyInArrow(run, f"{kinds}, n_words long, embedding array<double>")
