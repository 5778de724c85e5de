"""Splits and evaluation.

ROC and AUC need running totals over the scores in order. A global running total is the
extreme hot key (one group holding every row), so it goes through ``ordered_window``: the
distinct scores are range-partitioned, summed per partition, and corrected by the totals of
earlier partitions (a table of one row per partition). Nothing is ranked in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.operators.sequence import ordered_window

# Seed and training share of the risk model split.
SPLIT_SEED = 1407
TRAIN_SHARE = 0.9


def split_column(key, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED):
    """Boolean column, never null: True for the training side. The first 32 bits of
    md5(key || seed) against ``share``: the same rows on any engine and any partitioning. A
    null key is hashed as an empty one; a share of 1 takes all rows."""
    k = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    bits = F.conv(F.substring(F.md5(F.concat(k, F.lit(str(seed)))), 1, 8), 16, 10).cast("bigint")
    return bits < F.lit(split_threshold(share))


def split_threshold(share: float) -> int:
    """Hash values below this (of 2^32) are on the training side."""
    return round(share * (1 << 32))


def hash_split(df: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """M1: deterministic train/test split on a key; disjoint and complete."""
    train = split_column(key, share, seed)
    return df.filter(train), df.filter(~train)


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """(negated score, positives, negatives) per distinct score; partial aggregates."""
    s = F.col(score).cast("double")
    y = F.col(label).cast("double")
    return (
        df.filter(s.isNotNull() & y.isNotNull())
        .groupBy(s.alias("score"))
        .agg(F.sum(y).alias("pos"), F.sum(1.0 - y).alias("neg"))
        .withColumns({"__k": F.lit(0), "__neg_score": -F.col("score")})
    )


def _cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, highest first: pos, neg and their totals up to that score."""
    counts = _score_counts(df, score, label)
    cum = ordered_window(counts, "__k", "__neg_score", running_sums={"tp": "pos", "fp": "neg"})
    # Totals from the materialized running sums (no second scan of the input), as scalar
    # subqueries: computed once and used as constants, no join.
    totals = cum.agg(F.struct(F.sum("pos").alias("P"), F.sum("neg").alias("N"))).scalar()
    return cum.withColumns({"P": totals.getField("P"), "N": totals.getField("N")})


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """(threshold, fpr, tpr), one point per distinct score plus (inf, 0, 0)."""
    cum = _cumulative(df, score, label)
    points = cum.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("N")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("P")).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def auc(df: DataFrame, score: str, label: str) -> DataFrame:
    """M9: exact area under ROC (ties count one half), as one row ``auc``; null when a
    class is missing."""
    cum = _cumulative(df, score, label)
    area = F.try_divide(F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)), F.first("P") * F.first("N"))
    return cum.agg(area.alias("auc"))


def accuracy(df: DataFrame, pred: str, label: str) -> DataFrame:
    """Share of rows where prediction equals label, as one row ``accuracy``."""
    hit = (F.col(pred).cast("double") == F.col(label).cast("double")).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))
