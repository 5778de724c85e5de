"""Sources and sinks that must lose nothing: replaced tables, page files, pivots over found values."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from sparkrisk.operators import history as H
from sparkrisk.session import shared_dir
from sparkrisk.sources import pages as PG
from sparkrisk.sources import tables as TB


def test_replace_table_is_all_or_nothing(spark):
    name, path = f"replaced_{uuid.uuid4().hex[:8]}", shared_dir(spark, "replaced")
    TB.replace_table(spark.range(10), name, path)
    failing = spark.range(1000).select(F.when(F.col("id") < 999, F.col("id")).otherwise(F.raise_error(F.lit("killed")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        TB.replace_table(failing, name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(10))
    before = spark.table(name)
    TB.replace_table(spark.table(name).select((F.col("id") * 2).alias("id")), name, path)
    assert sorted(r.id for r in spark.table(name).collect()) == list(range(0, 20, 2))
    assert before.count() == 10  # a reader that had begun
    for _ in range(3):
        TB.replace_table(spark.table(name), name, path)
    assert spark.table(name).count() == 10
    import os

    assert len([d for d in os.listdir(path.removeprefix("file:")) if d.startswith("version-")]) == 2


def _pages(spark, tmp_path, rows, limit, **options):
    df = spark.range(rows).selectExpr("id", "'n' || id AS name").repartition(5)
    url = PG.write_page_files(df, str(tmp_path / "pages"), limit)
    PG.register_paged_api(spark)
    opts = {"url": url, "total": str(rows), "limit": str(limit), "wait": "0", **options}
    return df, spark.read.format("paged_api").schema("id string, name string").options(**opts)


def test_page_files_are_full_and_read_back(spark, tmp_path):
    df, reader = _pages(spark, tmp_path, 1003, 50)
    sizes = [len(json.loads((tmp_path / "pages" / f"page-{p}.json").read_text())["result"]["records"]) for p in range(21)]
    assert sizes == [50] * 20 + [3]
    assert sorted(map(tuple, reader.load().collect())) == sorted((str(r.id), r.name) for r in df.collect())
    with pytest.raises(ValueError):
        PG.write_page_files(df.limit(0), str(tmp_path / "none"), 50)


def test_short_or_missing_pages_are_errors(spark, tmp_path):
    _, reader = _pages(spark, tmp_path, 100, 50, retries="1")
    page = tmp_path / "pages" / "page-1.json"
    body = json.loads(page.read_text())
    body["result"]["records"].pop()
    page.write_text(json.dumps(body))
    with pytest.raises(Exception, match="49 records where 50 are due"):
        reader.load().collect()
    page.unlink()
    with pytest.raises(Exception, match="page 1"):
        reader.load().collect()


def test_failed_page_is_fetched_again(tmp_path):
    from pyspark.sql import types as T

    reader = PG.PagedApiReader(T.StructType.fromDDL("id string"), {
        "url": f"file://{tmp_path}/page-{{page}}.json", "total": "2", "limit": "2", "retries": "4", "wait": "0.05"})
    import threading

    whole = json.dumps({"result": {"total": 2, "records": [{"id": 1}, {"id": 2}]}})
    (tmp_path / "page-0.json").write_text(whole[:20])
    later = threading.Timer(0.1, lambda: (tmp_path / "page-0.json").write_text(whole))
    later.start()
    assert list(reader.read(reader.partitions()[0])) == [("1",), ("2",)]


def test_pivot_over_found_values(spark):
    rows = [("a", "x"), ("a", "x"), ("a", None), ("b", ""), ("b", "y.z"), (None, "x")]
    df = spark.createDataFrame(rows, "k string, v string")
    out = H.pivot_all(df, ["k"], "v")
    assert out.columns == ["k", "null", "blank", "x", "y.z"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [("a", 1, None, 2, None), ("b", None, 1, None, 1), (None, None, None, 1, None)], key=str)
    with pytest.raises(ValueError, match="more than 3"):
        H.pivot_all(df, ["k"], "v", most=3)
    with pytest.raises(ValueError, match="both give"):
        H.pivot_all(df.union(spark.createDataFrame([("a", "null")], df.schema)), ["k"], "v")
    with pytest.raises(ValueError, match="named like keys"):
        H.pivot_all(df.union(spark.createDataFrame([("a", "K")], df.schema)), ["k"], "v")
    assert H.pivot_all(df.limit(0), ["k"], "v").columns == ["k"]
