"""Benchmark decontamination by a broadcast set of n-grams (operator 11), DataFrame functions only.

1. Words are runs of ASCII letters and digits and of any character beyond ASCII, ASCII lower case.
   Every ``width`` consecutive words of a benchmark item are a window; a shorter item is one.
   Equal windows are one row: its words, their hash and the items that have it.
2. A document's words stay in its row; the hash of every window of the lengths that items have is
   looked up in the broadcast set (a hash join without a shuffle). A hit compares the words, so
   equal hashes of different words count for nothing.
3. The set is broadcast in blocks of at most ``MAX_WINDOWS`` windows: a benchmark beyond that size
   takes one pass over the documents per block, and nothing is left out.
4. Hits, a small part of the documents, are grouped by document: the covered words as ranges, and
   the items. A document that many rows repeat is one group with one entry per place.

Defined results: null and empty texts have no words, and an item without words has no window. Equal
rows have equal results; of rows with equal ids and different texts each has its own. Null ids are
kept. Items with one id count once, items without an id hit words but are not listed. An empty
benchmark contaminates nothing. Extra columns are ignored by the report and kept by ``remove``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkrisk.llm.common import let, stage

WIDTH = 10
# Windows broadcast at a time: with ten words each some 50 MB in an executor.
MAX_WINDOWS = 200_000
# Documents with hits broadcast to the final scan; more are joined by shuffle.
MAX_BROADCAST_HITS = 50_000

# What is not part of a (lower-case) word; runs of either, for texts as they are.
_OTHERS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_RUN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_RUNS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+|[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def words(text: Column) -> Column:
    """The words of a text, lower case; none for null. Splitting at the other characters is several
    times faster than extracting the words, which copies the text for every match."""
    return F.array_remove(F.split(_normal(text), _OTHERS), "")


def _row(text: Column) -> Column:
    """Tells texts with one id apart."""
    return F.xxhash64(text)


def _starts(size: Column, length: int) -> Column:
    """Places (from 1) of the windows of ``length`` words."""
    return F.when(size >= length, F.sequence(F.lit(1), size - length + 1)).otherwise(F.array().cast("array<int>"))


def _hash(each: Column, width: int) -> Column:
    """One hash of up to ``width`` words' hashes (what is missing adds nothing)."""
    return F.xxhash64(*[F.get(each, F.lit(k)) for k in range(width)])


def _window_hashes(each: Column, length: int) -> Column:
    """The hash of every window of ``length`` words, from the words' hashes."""
    return F.transform(_starts(F.size(each), length), lambda i: F.xxhash64(*[F.get(each, i + k - 1) for k in range(length)]))


def windows(items: DataFrame, width: int = WIDTH, key: str = "item_id", text: str = "text") -> DataFrame:
    """(length, words, h, items): every different window with the ids of the items that have it."""
    own = items.select(items[key].cast("string").alias("item"), words(items[text]).alias("w")).filter(F.size("w") > 0)
    length = F.least(F.size("w"), F.lit(width))
    every = own.select("item", length.alias("length"), F.explode(
        F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))).alias("words"))
    sets = every.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    return sets.select("length", "words", _hash(F.transform("words", lambda x: F.xxhash64(x)), width).alias("h"), "items")


def _looked_up(docs: DataFrame, side: DataFrame, lengths: list[int], key: str, text: str) -> DataFrame:
    """(key, row, length, place, items) of every occurrence of a window of ``side``."""
    own = docs.select(docs[key].alias("key"), _row(docs[text]).alias("row"), words(docs[text]).alias("w"))

    # Places of all lengths in one array, length after length; which of them a hit belongs to is
    # told by its window's length.
    def hashes(each: Column) -> Column:
        return F.concat(*[_window_hashes(each, n) for n in lengths])

    each = F.transform("w", lambda x: F.xxhash64(x))
    # The hashes are a column before they are exploded: a generator over a lambda leaves generated
    # code and would copy the words of the document for every window. The outer form infers no filter
    # on the array's size, for which all hashes would be computed twice.
    own = own.select("key", "row", "w", let(each, hashes).alias("hashes"))
    placed = own.select("key", "row", "w", F.posexplode_outer("hashes").alias("at", "h"))
    before, skipped = F.lit(0), F.when(F.lit(False), F.lit(0))
    for n in lengths:
        skipped = skipped.when(F.col("length") == n, before)
        before = before + F.greatest(F.size("w") - n + 1, F.lit(0))
    side = side.withColumnRenamed("h", "hash")
    place = F.col("at") - skipped + 1
    hit = (F.col("h") == F.col("hash")) & (F.slice("w", place, F.col("length")) == F.col("words"))
    return placed.join(F.broadcast(side), hit).select("key", "row", "length", place.alias("place"), "items")


def find_hits(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text",
              item_key: str = "item_id", item_text: str = "text", most: int = MAX_WINDOWS) -> DataFrame:
    """(key, row, spans, items): for every document with a hit the covered words as ranges (first
    word, word after the last; from 0) and the ids of the items found, sorted as strings."""
    sets = stage(windows(items, width, item_key, item_text), "windows")
    sizes = {r["length"]: r["n"] for r in sets.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # width rows
    lengths, blocks = sorted(sizes), -(-sum(sizes.values()) // most)
    if not lengths:
        found = docs.select(docs[key].alias("key"), F.lit(0).cast("long").alias("row"), F.lit(0).alias("length"),
                            F.lit(0).alias("place"), F.array().cast("array<string>").alias("items")).limit(0)
    else:
        parts = [sets if blocks == 1 else sets.filter(F.pmod("h", F.lit(blocks)) == b) for b in range(blocks)]
        found = reduce(DataFrame.unionAll, [_looked_up(docs, p, lengths, key, text) for p in parts])
    places = F.collect_set(F.struct((F.col("place") - 1).alias("first"), (F.col("place") - 1 + F.col("length")).alias("past")))
    per = found.groupBy("key", "row").agg(places.alias("places"), F.collect_set("items").alias("sets"))
    empty = F.array().cast("array<struct<first:int,past:int>>")
    last = lambda a: F.get(a, F.size(a) - 1)

    def merge(spans: Column, s: Column) -> Column:
        joined = F.concat(F.slice(spans, 1, F.size(spans) - 1),
                          F.array(F.struct(last(spans)["first"].alias("first"), F.greatest(last(spans)["past"], s["past"]).alias("past"))))
        return F.when(last(spans)["past"] >= s["first"], joined).otherwise(
            F.concat(spans, F.array(s)))

    return per.select("key", "row", F.aggregate(F.array_sort("places"), empty, merge).alias("spans"),
                      F.array_sort(F.array_distinct(F.flatten("sets"))).alias("items")).withColumnRenamed("key", key)


def _with_hits(docs: DataFrame, hits: DataFrame, key: str, on_row: Column) -> DataFrame:
    """``docs`` with the columns ``spans`` and ``items`` of their hits (null without)."""
    side = hits.select(F.col(key).alias("__key"), F.col("row").alias("__row"), F.col("spans").alias("__spans"), F.col("items").alias("__items"))
    if side.limit(MAX_BROADCAST_HITS + 1).count() <= MAX_BROADCAST_HITS:
        side = F.broadcast(side)
    return docs.join(side, docs[key].eqNullSafe(F.col("__key")) & (on_row == F.col("__row")), "left").drop("__key", "__row")


def report(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    hits = stage(find_hits(docs, items, width, key, text, **options), "hits")
    counted = docs.select(docs[key], F.size(words(docs[text])).cast("long").alias("n_words"), _row(docs[text]).alias("row"))
    out = _with_hits(counted, hits, key, counted["row"])
    n_hit = F.aggregate(F.col("__spans"), F.lit(0).cast("long"), lambda a, s: a + s["past"] - s["first"])
    n_hit = F.coalesce(n_hit, F.lit(0).cast("long"))
    found = F.coalesce("__items", F.array().cast("array<string>"))
    return out.select(key, "n_words", n_hit.alias("n_hit"), F.size(found).cast("long").alias("n_items"),
                      F.sha2(F.array_join(found, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, what: str = "spans", share: float = 0.0, width: int = WIDTH,
           key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without their benchmark passages. ``what="documents"`` drops those of whose words more
    than ``share`` are hit; ``what="spans"`` takes the hit words, and what stands between them, out
    of the texts."""
    if what not in ("spans", "documents"):
        raise ValueError(f"remove 'spans' or 'documents', not {what!r}")
    hits = stage(find_hits(docs, items, width, key, text, **options), "hits")
    out = _with_hits(docs, hits, key, _row(docs[text]))
    if what == "documents":
        n_hit = F.aggregate(F.col("__spans"), F.lit(0), lambda a, s: a + s["past"] - s["first"])
        return out.filter(F.col("__spans").isNull() | (n_hit <= F.lit(share) * F.size(words(F.col(text))))).select(*docs.columns)
    runs = F.regexp_extract_all(F.col(text), F.lit(_RUNS), F.lit(0))
    # Runs alternate between words and others; a text that starts with others has its words at odd places.
    shift = F.when(F.col(text).rlike(r"\A" + _WORD_RUN), 0).otherwise(1)
    spans = F.col("__spans")

    def kept(all_runs: Column) -> Column:
        inside = lambda i: F.exists(spans, lambda s: (i >= 2 * s["first"] + shift) & (i <= 2 * (s["past"] - 1) + shift))
        return F.array_join(F.filter(all_runs, lambda r, i: ~inside(i)), "")

    cut = F.when(spans.isNull(), F.col(text)).otherwise(let(runs, kept))
    return out.withColumn(text, cut).select(*docs.columns)
