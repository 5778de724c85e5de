"""Text to token ids and back (T1-T6, T8 counts, J3-J5).

Texts are split whole, on an explicit whitespace class. Token rows come from ``posexplode``
(narrow, no shuffle); the vocabulary has at most ``n`` rows, a bound that does not grow with
the data, so joins against it are broadcast hash joins. Encoding, decoding and window counts keep
a text in its row and work on Arrow columns (``arrow_text``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkrisk.functions.scalar import join_words, split_words
from sparkrisk.operators import arrow_text
from sparkrisk.operators.joins import max_rows

# Vocabulary size and sequence length of the text model inputs.
VOCAB_SIZE = 5000
SEQ_LEN = 250
# Largest vocabulary broadcast to every task; larger ones are joined by shuffle, the tokens of
# each word dealt over this many tasks (a frequent word is a hot key).
MAX_BROADCAST_VOCAB = 1_000_000
WORD_SALTS = 32


def labelled_text(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Texts with their labels (inner join on the key)."""
    return docs.join(labels, key)


def tokens(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per non-empty whitespace-separated token: (key, pos, word)."""
    return df.select(key, F.posexplode(split_words(text)).alias("pos", "word"))


def words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per non-empty token, without positions (what counting needs)."""
    return df.select(F.explode(split_words(text)).alias("word"))


def vocabulary(toks: DataFrame, n: int = VOCAB_SIZE, word: str = "word") -> DataFrame:
    """The ``n`` most frequent words; id = frequency rank from 1, ties by word.

    Counts are a partial aggregate; the top-n is a bounded per-task heap merged once (``n``
    rows), so the final numbering runs over at most ``n`` rows.
    """
    counts = toks.groupBy(word).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.col("count").desc(), F.col(word)).limit(n)
    rank = Window.orderBy(F.col("count").desc(), F.col(word))
    return top.select(word, F.row_number().over(rank).alias("id"), "count")


def _join_vocab(toks: DataFrame, vocab: DataFrame, on: str, how: str, most: int = MAX_BROADCAST_VOCAB) -> DataFrame:
    """Join tokens with a vocabulary. One from ``vocabulary()`` carries its ``limit``, so its bound
    is proven and it is broadcast. Any other is repeated once per salt and joined by shuffle on
    (value, salt), so the tokens of a frequent word are spread over ``WORD_SALTS`` tasks."""
    bound = max_rows(vocab)
    if bound is not None and bound <= most:
        return toks.join(F.broadcast(vocab), on, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(WORD_SALTS - 1))).alias("__salt")
    salted = toks.withColumn("__salt", F.pmod(F.xxhash64(*toks.columns), F.lit(WORD_SALTS)).cast("int"))
    return salted.join(vocab.select("*", salts), [on, "__salt"], how).drop("__salt")


def known_tokens(toks: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    """Tokens present in the vocabulary (semi join against the bounded vocabulary)."""
    return _join_vocab(toks, vocab.select(word), word, "left_semi")


def lookup(toks: DataFrame, vocab: DataFrame, word: str = "word") -> DataFrame:
    """Token to id (inner join; unknown words drop out)."""
    return _join_vocab(toks, vocab.select(word, "id"), word, "inner")


def _row_key(content: str) -> list[Column]:
    """What tells rows of one key apart: a hash of their content."""
    return [F.xxhash64(F.col(content)).alias("__row")]


def _regroup(items: DataFrame, key: str, value: str) -> DataFrame:
    """(key, list) per original row: its non-null values in ``pos`` order. Equal rows of a key share
    a group; every item is there once per row, and the first position tells how many rows."""
    item = F.when(F.col(value).isNotNull(), F.struct(F.col("pos"), F.col(value).alias("v")))
    rows = F.count_if(F.coalesce(F.col("pos"), F.lit(0)) == 0).cast("int")
    grouped = items.groupBy(key, "__row").agg(F.array_sort(F.collect_list(item)).alias("__items"), rows.alias("__n"))
    one = F.transform(F.filter("__items", lambda x, i: i % F.col("__n") == 0), lambda s: s["v"])
    return grouped.select(key, one.alias("list"), F.explode(F.sequence(F.lit(1), F.col("__n"))).alias("__i")).select(key, "list")


def _bounded(vocab: DataFrame, most: int):
    """A vocabulary whose plan proves at most ``most`` rows, as an Arrow table; else None."""
    bound = max_rows(vocab)
    return vocab.select("word", "id").toArrow() if bound is not None and bound <= most else None


def encode(df: DataFrame, vocab: DataFrame, text: str = "text", key: str = "doc_id",
           most: int = MAX_BROADCAST_VOCAB) -> DataFrame:
    """T4: (key, ids) with the ids of known words in text order, one row per row of ``df``
    (repeated keys are separate texts); a text without any known word gets an empty array.

    A bounded vocabulary (one from ``vocabulary()`` is) goes to the tasks, and every row is looked up
    where it is, without a shuffle. Any other is joined with the tokens by a salted shuffle; all
    tokens of a text are then grouped again.
    """
    own = _bounded(vocab, most)
    if own is not None:
        return arrow_text.lookup_ids(df, own, text, key)
    toks = df.select(key, *_row_key(text), F.posexplode_outer(split_words(text)).alias("pos", "word"))
    ids = _join_vocab(toks, vocab.select("word", "id"), "word", "left", most)
    return _regroup(ids, key, "id").withColumnRenamed("list", "ids")


def decode(df: DataFrame, vocab: DataFrame, ids: str = "ids", key: str = "doc_id",
           most: int = MAX_BROADCAST_VOCAB) -> DataFrame:
    """(key, text) with the words of the ids joined by one space, one row per row of
    ``df``; vocabularies as in ``encode``."""
    own = _bounded(vocab, most)
    if own is not None:
        return arrow_text.lookup_words(df, own, ids, key)
    exploded = df.select(key, *_row_key(ids), F.posexplode_outer(ids).alias("pos", "id"))
    words = _join_vocab(exploded, vocab.select("word", "id"), "id", "left", most)
    return _regroup(words, key, "word").select(key, join_words(F.col("list")).alias("text"))


def pad(df: DataFrame, col: str = "ids", n: int = SEQ_LEN, out: str | None = None) -> DataFrame:
    """Zeros in front up to ``n``; longer arrays keep their last ``n`` ids."""
    a = F.col(col)
    size = F.size(a)
    kept = F.slice(a, F.greatest(size - F.lit(n) + 1, F.lit(1)), n)
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(n) - size, F.lit(0)))
    return df.withColumn(out or col, F.concat(zeros, kept))


def seen_ids(toks_with_ids: DataFrame, train_ids: DataFrame, vocab: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id occurs in the training ids. The seen ids are taken from the
    vocabulary, whose size is bounded, so the tokens are never shuffled by id."""
    used = train_ids.groupBy(id_col).agg(F.count(F.lit(1)).alias("__uses")).select(id_col)
    seen = vocab.select(id_col).join(used, id_col, "left_semi")
    return _join_vocab(toks_with_ids, seen, id_col, "left_semi")


def ngrams(df: DataFrame, text: str = "text", key: str = "doc_id", n: int = 3) -> DataFrame:
    """T8 counts: (key, ngram, count) of width-``n`` word windows, words joined by a space,
    the same strings MLlib's ``NGram`` produces. Windows are counted inside their row, without a
    shuffle; repeated keys are separate texts."""
    return arrow_text.window_counts(df, text, key, n)
