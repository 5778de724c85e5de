"""Session helpers: settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings a job needs for deterministic, comparable results. They are runtime SQL
# settings, so they can be applied to a session someone else built.
JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lists per text are collected by hash for this many texts of a task before the aggregate
    # falls back to sorting every token (128 by default).
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the job settings to an existing session and return it."""
    for k, v in JOB_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "sparkrisk",
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the local bench. Clusters pass their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SPARKRISK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once their DataFrames are garbage collected.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Managed tables of local runs go to a scratch folder, not the working directory.
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sparkrisk-warehouse-"))
    )
    for k, v in {**JOB_SETTINGS, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    The folder named in ``spark.checkpoint.dir`` is read from the session. Only a local-mode
    session without one (tests, local runs) gets a folder under the local temp folder; a
    cluster session without one is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        conf = sc.getConf().get("spark.checkpoint.dir", None)
        if not conf:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                # A machine-local folder is not visible to other executors.
                raise RuntimeError("set spark.checkpoint.dir to a folder on the shared file system")
            conf = tempfile.mkdtemp(prefix="sparkrisk-")
        sc.setCheckpointDir(conf)
        base = sc.getCheckpointDir()
    return base


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh, unused folder path under the shared checkpoint folder."""
    sub = f"{name or 'tmp'}-{uuid.uuid4().hex[:12]}"
    return checkpoint_dir(spark).rstrip("/") + "/" + sub


def materialize(df: DataFrame, how: str | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    Used where one intermediate feeds two branches whose results must agree row for row
    (e.g. partition ids after a range exchange). ``how="parquet"`` (default) writes a
    compressed columnar stage, so each branch reads only the columns it uses;
    ``how="checkpoint"`` uses ``DataFrame.checkpoint``. Both are reliable (never a local
    checkpoint): the files outlive any executor, and the lineage is cut. ``compression`` is that of
    the Parquet stage, the session's by default.
    """
    spark = df.sparkSession
    how = how or spark.conf.get("sparkrisk.materialize", "parquet")
    if how == "checkpoint":
        checkpoint_dir(spark)
        return df.checkpoint(eager=True)
    return spark.read.parquet(write_stage(df, "stage", compression))


def write_stage(df: DataFrame, name: str, compression: str | None = None) -> str:
    """Write ``df`` to a fresh folder under the shared checkpoint folder, owned by the innermost open
    ``stage_scope``; returns its path."""
    path = shared_dir(df.sparkSession, name)
    owner = _SCOPE.get()
    if owner is not None:  # before the write: a failed one is deleted too
        owner.append(path)
    df.write.parquet(path, compression=compression)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes inside the block remove their shuffle files as they end, and not when the driver happens to
    collect its garbage. Frames that are built inside and used again would shuffle anew."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


# Stage folders of the innermost open ``stage_scope``; None outside of any.
_SCOPE: ContextVar[list[str] | None] = ContextVar("stages", default=None)


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Own the stage folders written inside the block and delete them at its end (no others:
    scopes nest, and frames built elsewhere stay readable). Write results out inside the block.
    Stages written outside of any scope stay in the checkpoint folder."""
    own: list[str] = []
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for name in own:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
