"""Sources and sinks: page plan, paged data source, file counts."""

import json
import os
from pathlib import Path

from pyspark.sql import types as T

from sparkrisk.session import shared_dir
from sparkrisk.sources import pages as PG
from sparkrisk.sources import tables as TB


def test_page_plan(spark):
    rows = [(r.page, r.offset) for r in PG.page_plan(10001, 5000, spark=spark).orderBy("page").collect()]
    assert rows == [(0, 0), (1, 5000), (2, 10000)]
    assert PG.page_plan(0, 5000, spark=spark).count() == 0


def test_paged_api_source_reads_every_page(spark, tmp_path):
    for p in range(3):
        recs = [{"_id": p * 10 + i, "name": f"n{p}{i}", "extra": 1} for i in range(4 if p < 2 else 2)]
        (tmp_path / f"page-{p}.json").write_text(json.dumps({"result": {"total": 10, "records": recs}}))
    PG.register_paged_api(spark)
    df = (spark.read.format("paged_api").schema("_id string, name string, missing string")
          .options(url=f"file://{tmp_path}/page-{{page}}.json", total="10", limit="4").load())
    typed = PG.conform(df, T.StructType.fromDDL("_id int, name string, missing string"))
    rows = sorted((r._id, r.name, r.missing) for r in typed.collect())
    assert len(rows) == 10 and rows[0] == (0, "n00", None)
    grouped = (spark.read.format("paged_api").schema("_id string, name string")
               .options(url=f"file://{tmp_path}/page-{{page}}.json", total="10", limit="4",
                        pages_per_partition="2").load())
    assert grouped.rdd.getNumPartitions() == 2 and grouped.count() == 10


def test_file_count(spark):
    path = TB.write_parquet(spark.range(1000), shared_dir(spark, "files"), files=3)
    local = path.removeprefix("file:")  # the local test checkpoint folder is a file: URI
    assert len([f for f in os.listdir(local) if f.endswith(".parquet")]) == 3
    assert Path(local).exists()


def test_read_pages_one_document_per_file(spark, tmp_path):
    schema = T.StructType.fromDDL("_id int, name string, absent string")
    for p in range(2):
        recs = [{"_id": p * 10 + i, "name": f"n{i}", "unknown": True} for i in range(3)]
        (tmp_path / f"page-{p}.json").write_text(json.dumps({"result": {"total": 6, "records": recs}}, indent=2))
    df = PG.conform(PG.read_pages(spark, str(tmp_path), schema, multiline=True), schema)
    rows = sorted((r._id, r.name, r.absent) for r in df.collect())
    assert rows == [(0, "n0", None), (1, "n1", None), (2, "n2", None), (10, "n0", None), (11, "n1", None),
                    (12, "n2", None)]
    assert df.columns == ["_id", "name", "absent"]


def test_read_pages_loses_nothing_silently(spark, tmp_path):
    import pytest

    schema = T.StructType.fromDDL("_id int, name string")
    whole = json.dumps({"result": {"total": 2, "records": [{"_id": 1, "name": "a"}]}})
    (tmp_path / "a.json").write_text(whole)
    (tmp_path / "b.json").write_text(whole[:-9])  # a truncated page
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        PG.read_pages(spark, str(tmp_path), schema).collect()
    (tmp_path / "b.json").write_text(whole.replace('"_id": 1', '"_id": "x2"'))
    with pytest.raises(Exception, match="_id: cannot read x2"):
        PG.read_pages(spark, str(tmp_path), schema).collect()
    assert len(PG.read_pages(spark, str(tmp_path), T.StructType.fromDDL("_id string, name string")).collect()) == 2


def test_write_pages_keeps_every_record(spark, tmp_path):
    schema = T.StructType.fromDDL("_id bigint, v string")
    df = spark.range(1234).selectExpr("id % 400 AS _id", "CAST(id % 3 AS STRING) AS v").repartition(7)
    path = PG.write_pages(df, str(tmp_path / "p"), 50)
    sizes = [len(r.result.records) for r in spark.read.json(path).collect()]
    assert sum(sizes) == 1234 and max(sizes) <= 50
    back = PG.read_pages(spark, path, schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_write_pages_holds_one_page_at_a_time(spark, tmp_path, monkeypatch):
    df = spark.range(0, 1234, 1, 3).selectExpr("id AS _id", "CAST(id AS DOUBLE) AS v", "if(id % 2 = 0, 'a', NULL) AS w")
    df = df.sortWithinPartitions("_id")
    monkeypatch.setattr(type(df), "groupBy", None)  # grouped rows are held until their task ends
    path = PG.write_pages(df, str(tmp_path / "p"), 50)
    pages = [[r._id for r in p.result.records] for p in spark.read.json(path).collect()]
    assert all(ids == list(range(ids[0], ids[0] + len(ids))) for ids in pages)  # in the order of the rows
    assert sum(len(ids) < 50 for ids in pages) <= 3  # only the last page of a task is short
    back = PG.read_pages(spark, path, df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_landed_pages_take_little_disk(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(PG, "FILE_RECORDS", 100)
    local, folders = shared_dir(spark, "x").removeprefix("file:"), lambda: set(os.listdir(os.path.dirname(local)))
    before = folders()
    df = spark.range(0, 1000, 1, 2).selectExpr("id AS _id", "concat('a rather long text ', id % 7) AS v")
    joined = df.repartition(5, "v").join(spark.range(1000).withColumnRenamed("id", "_id").hint("merge"), "_id")
    path = PG.write_pages(joined, str(tmp_path / "p"), 50)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert all(f.endswith(".json.gz") for f in files) and len(files) >= 10  # one task a file: at most 100 records
    assert not [x for x in folders() - before if x.startswith("stage")]
    assert len(PG.read_pages(spark, path, joined.schema).collect()) == 1000


def test_shuffles_are_dropped_with_their_write(spark, tmp_path):
    from sparkrisk.session import shuffles_dropped

    files = lambda: blocks.diskBlockManager().getAllFiles().mkString(",").count("shuffle_")
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = files(), spark.conf.get(key, None)
    with shuffles_dropped(spark):
        spark.range(1000).repartition(3, "id").write.parquet(str(tmp_path / "a"))
    assert files() <= before and spark.conf.get(key, None) == was
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000


def test_page_files_are_whole_and_in_order(spark, tmp_path):
    df = spark.range(0, 1234, 1, 3).selectExpr("id AS _id", "concat('ä', id) AS v")
    PG.write_page_files(df, str(tmp_path / "p"), 100)
    pages = [json.loads((tmp_path / "p" / f"page-{n}.json").read_text())["result"] for n in range(13)]
    assert [p["total"] for p in pages] == [1234] * 13
    ids = [[r["_id"] for r in p["records"]] for p in pages]
    assert [len(x) for x in ids] == [100] * 12 + [34] and sorted(sum(ids, [])) == list(range(1234))


def test_paged_api_values_as_the_json_reader_gives_them(spark, tmp_path):
    recs = [{"_id": 1, "flag": True, "obj": {"a": 1}, "name": "n"}]
    (tmp_path / "page-0.json").write_text(json.dumps({"result": {"total": 1, "records": recs}}, separators=(",", ":")))
    PG.register_paged_api(spark)
    fields = "_id string, flag string, obj string, name string"
    api = spark.read.format("paged_api").schema(fields).options(url=f"file://{tmp_path}/page-{{page}}.json", total="1", limit="4").load()
    files = PG.read_pages(spark, str(tmp_path), T.StructType.fromDDL(fields))
    assert api.collect() == files.collect() and api.first().flag == "true" and api.first().obj == '{"a":1}'


def test_parse_times_mapping_and_bad_text(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05", "not-a-date")], "issdttm string, violdttm string")
    own = PG.parse_times(df, ["issdttm", "violdttm"]).first()
    assert str(own.issdttm) == "2020-01-02 03:04:05" and own.violdttm is None
    # each column parsed from another one, e.g. every later time column from the issue time
    mapped = PG.parse_times(df, {"issdttm": "issdttm", "violdttm": "issdttm"}).first()
    assert mapped.violdttm == mapped.issdttm


def test_empty_table_written_with_schema(spark):
    import uuid

    from sparkrisk.schemas import HISTORY, INSPECTIONS_RAW

    name = f"empty_{uuid.uuid4().hex[:8]}"
    t = TB.empty_table(spark, HISTORY, name, shared_dir(spark, "empty"))
    assert t.count() == 0 and t.schema == HISTORY
    assert TB.empty_table(spark, INSPECTIONS_RAW).columns == INSPECTIONS_RAW.fieldNames()
