"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk.session import prepare, write_stage

# Largest Arrow batch handed to a Python task: rows, and bytes where Spark knows the setting. Tasks
# make several 8-byte numbers of every byte of a batch.
BATCH_ROWS = 400
BATCH_BYTES = 4 * 1024 * 1024


def setup(spark: SparkSession) -> SparkSession:
    """Job settings, and Arrow batches small enough for long texts."""
    prepare(spark)
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                       ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) != str(value):
            spark.conf.set(key, str(value))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return setup(spark).read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder (``spark.checkpoint.dir``) and read it
    from there: the lineage is cut, several readers see the same rows, and the files outlive
    any executor. An open ``stage_scope`` deletes them at its end."""
    return df.sparkSession.read.schema(df.schema).parquet(write_stage(df, name))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def join_small(rows: DataFrame, side: DataFrame, on, how: str, most: int) -> DataFrame:
    """Join a written table: by broadcast if it has at most ``most`` rows, else by shuffle."""
    return rows.join(F.broadcast(side) if side.limit(most + 1).count() <= most else side, on, how)
