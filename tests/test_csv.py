"""Delimited files: texts come back as they were, bad records are not lost."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkrisk.plans.q_sources import HOSTILE
from sparkrisk.session import shared_dir
from sparkrisk.sources import tables as TB

NINE = ["a\nb", 'q"x', "back\\", "", None, " ", "x;y", 'e\\"z', "cr\rx"]
TEXTS = [*NINE, *HOSTILE, "\\\\", "\\\n", "\\\\n", "\\\\\\r", "\r\n", ";", "\t", "'", "ü\u2028", " lead", "trail ", '""', '"a";"b"', "#"]


def same(a, b):
    return sorted(a, key=repr) == sorted(b, key=repr)


@pytest.mark.parametrize("shape", ["t string", "id int, t string", "t string, id int, u string"])
def test_texts_come_back(spark, shape):
    schema = T.StructType.fromDDL(shape)
    rows = [tuple({"t": t, "id": i, "u": t}[f.name] for f in schema.fields) for i, t in enumerate(TEXTS)] * 2
    df = spark.createDataFrame(rows, schema)
    path = TB.write_csv(df, shared_dir(spark, "csv"))
    lines = [r.value for r in spark.read.text(path, lineSep="\n").collect()]
    assert all("\r" not in x for x in lines)
    got = TB.read_csv(spark, path, schema=schema)
    assert same([tuple(r) for r in got.collect()], rows)
    TB.write_csv(df, path, mode="append")
    assert TB.read_csv(spark, path, schema=schema).count() == 2 * len(rows)


def test_null_rows_of_several_columns(spark):
    df = spark.createDataFrame([(None, None), ("", None), (None, "")], "a string, b string")
    got = TB.read_csv(spark, TB.write_csv(df, shared_dir(spark, "csv")), schema=df.schema)
    assert same([tuple(r) for r in got.collect()], [(None, None), ("", None), (None, "")])


def test_foreign_files_are_read_as_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id;path\n1;C:\\new\\\\x\n2;"two\nlines"\n')
    got = TB.read_csv(spark, str(tmp_path), schema=T.StructType.fromDDL("id int, path string"), multi_line=True)
    assert same([tuple(r) for r in got.collect()], [(1, "C:\\new\\\\x"), (2, "two\nlines")])
    with pytest.raises(ValueError):
        TB.write_csv(got, str(tmp_path), mode="append")


def test_bad_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k;v\n1;a\nxx;lost\n2;b\n3\n4;c;d\n;e\n')
    schema = T.StructType.fromDDL("k int, v string")
    rows, bad = TB.read_csv(spark, str(tmp_path), schema=schema, bad="apart")
    assert same([tuple(r) for r in rows.collect()], [(1, "a"), (2, "b"), (None, "e")])
    assert sorted(r.record for r in bad.collect()) == ["3", "4;c;d", "xx;lost"]
    assert rows.count() == 3 and bad.count() == 3 and rows.select("k").count() == 3
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE|corrupt"):
        TB.read_csv(spark, str(tmp_path), schema=schema).select("k").collect()
    with pytest.raises(ValueError):
        TB.read_csv(spark, str(tmp_path), schema=schema, bad="drop")


def test_scans_can_be_split(spark):
    df = spark.range(20000).selectExpr("id", "concat('text ', id) AS t")
    path = TB.write_csv(df, shared_dir(spark, "csv"), files=1)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = TB.read_csv(spark, path, schema=df.schema)
        assert got.rdd.getNumPartitions() > 1 and got.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_rows_that_share_a_column_are_written_together(spark, tmp_path):
    rows = spark.range(0, 5000, 1, 4).selectExpr("id", "IF(id % 50 = 0, NULL, 'k' || id % 50) AS k", "'a;\n' || id AS t")
    path = TB.write_csv(rows, str(tmp_path / "csv"), by=["k"])
    back = TB.read_csv(spark, path, schema=rows.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    files = back.withColumn("f", F.input_file_name()).groupBy("k").agg(F.countDistinct("f").alias("n"))
    assert {r.n for r in files.collect()} == {1}
