"""A training corpus from raw documents: low-quality documents go, one document of every group
of near-duplicates stays, passages that occurred before go, personal data is generalised, and
the rest is packed into token sequences.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over everything its predecessor kept; its
result is written as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs`` (``n_chars``, if present, follows the text). Empty tables, null texts and
null ids go through; see the operators' docstrings for the defined results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk.llm import crf, disclosure, minhash, packing, substring
from sparkrisk.llm.common import setup, stage, table

QUALITY_THRESHOLD = 0.3
SHINGLE = 5  # words
SIMILARITY = 80  # hundredths
CAPACITY = 4096
END_ID = 1


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the texts as they are now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score by the line model is at least ``QUALITY_THRESHOLD``."""
    setup(spark)
    model = crf.fit(docs, table(spark, sf_dir, "labels"))
    return crf.score(docs, model, out="__quality").filter(F.col("__quality") >= QUALITY_THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group."""
    setup(spark)
    return minhash.drop_near_duplicates(docs, shingle=SHINGLE, percent=SIMILARITY)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the windows of 20 words that occurred before."""
    setup(spark)
    return _measured(substring.remove_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data, and terms that give it away, replaced by their kind."""
    setup(spark)
    return _measured(disclosure.sanitise(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of ``CAPACITY`` ids."""
    import public_tokenizers

    setup(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID, CAPACITY)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", sequences),
]

# A trained model, hashing and token ids are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
