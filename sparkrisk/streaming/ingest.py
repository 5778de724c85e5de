"""Incremental ingest of landed pages (C1 as a stream).

Pages landing in a folder are picked up by the file source, unnested, conformed and parsed
with the same expressions as the batch job, and appended to a parquet table by the file
sink. The checkpoint (in the shared checkpoint folder) and the sink's commit log make each
page count exactly once across restarts and lost executors. ``availableNow`` processes
whatever has landed and stops, which suits scheduled runs.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkrisk.schemas import as_text_schema, page_envelope
from sparkrisk.sources.pages import _strict, parse_times


def page_stream(spark: SparkSession, landing_path: str, record_schema: T.StructType,
                time_cols: Sequence[str] | Mapping[str, str], max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of typed records from page files landing in ``landing_path``."""
    reader = spark.readStream.schema(page_envelope(as_text_schema(record_schema)))
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    env = reader.option("mode", "FAILFAST").json(landing_path)
    return parse_times(_strict(env.select(F.inline("result.records")), record_schema), time_cols)


def ingest_stream(spark: SparkSession, landing_path: str, record_schema: T.StructType,
                  time_cols: Sequence[str] | Mapping[str, str], sink_path: str,
                  checkpoint: str | None = None, wait: bool = True) -> StreamingQuery:
    """Append newly landed pages to the parquet table at ``sink_path``. The checkpoint belongs to
    the sink: by default it is the folder ``<sink_path>-checkpoint``, the same in every call (a
    fresh one would number its batches from 0 again, which the sink takes for written)."""
    stream = page_stream(spark, landing_path, record_schema, time_cols)
    q = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint or sink_path.rstrip("/") + "-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    if wait:
        q.awaitTermination()
    return q
