"""The page stream appends each landed page exactly once across restarts."""

from pyspark.sql import functions as F

from sparkrisk.session import shared_dir
from sparkrisk.sources import pages as PG
from sparkrisk.sources import tables as TB
from sparkrisk.streaming.ingest import ingest_stream
from sparkrisk.plans.q_sources import RECORD_SCHEMA


def _batch(spark, lo, hi):
    df = spark.range(lo, hi).select(
        F.col("id").alias("_id"),
        F.col("id").cast("string").alias("property_id"),
        F.lit("2001-02-03 04:05:06").alias("resultdttm"),
        F.lit("bad").alias("issdttm"),
    )
    return df


def test_default_checkpoint_belongs_to_the_sink(spark):
    landing, sink = shared_dir(spark, "land"), shared_dir(spark, "sink")
    PG.write_pages(_batch(spark, 0, 300), landing + "/a", 100)
    ingest_stream(spark, landing + "/*", RECORD_SCHEMA, ["resultdttm", "issdttm"], sink)
    assert TB.read_table(spark, sink).count() == 300
    PG.write_pages(_batch(spark, 300, 450), landing + "/b", 100)
    ingest_stream(spark, landing + "/*", RECORD_SCHEMA, ["resultdttm", "issdttm"], sink)
    assert TB.read_table(spark, sink).count() == 450


def test_restart_appends_only_new_pages(spark):
    landing, sink, ckpt = shared_dir(spark, "land"), shared_dir(spark, "sink"), shared_dir(spark, "ckpt")
    PG.write_pages(_batch(spark, 0, 300), landing + "/a", 100)
    ingest_stream(spark, landing + "/*", RECORD_SCHEMA, ["resultdttm", "issdttm"], sink, checkpoint=ckpt)
    assert TB.read_table(spark, sink).count() == 300
    # same checkpoint, nothing new: nothing appended
    ingest_stream(spark, landing + "/*", RECORD_SCHEMA, ["resultdttm", "issdttm"], sink, checkpoint=ckpt)
    assert TB.read_table(spark, sink).count() == 300
    # new pages land: only they are appended
    PG.write_pages(_batch(spark, 300, 450), landing + "/b", 100)
    ingest_stream(spark, landing + "/*", RECORD_SCHEMA, ["resultdttm", "issdttm"], sink, checkpoint=ckpt)
    out = TB.read_table(spark, sink)
    assert out.count() == 450 and out.select("_id").distinct().count() == 450
    row = out.filter("_id = 7").first()
    assert str(row.resultdttm) == "2001-02-03 04:05:06" and row.issdttm is None


def test_ingest_moves_the_records_of_an_entity_together(spark):
    landing, table = shared_dir(spark, "land"), "ingested_together"
    df = _batch(spark, 0, 900).withColumn("property_id", F.when(F.col("_id") % 3 > 0, (F.col("_id") % 3).cast("string")))
    PG.write_pages(df.repartition(6), landing, 100)
    written = shared_dir(spark, "table")
    out = PG.ingest(spark, landing, RECORD_SCHEMA, ["resultdttm", "issdttm"], table, written, by=["property_id"])
    rows = out.groupBy("property_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("_id").alias("ids"))
    assert sorted(((r.property_id, r.n, r.ids) for r in rows.collect()), key=str) == [("1", 300, 300), ("2", 300, 300), (None, 300, 300)]
    spark.sql(f"DROP TABLE {table}")
