"""The skew-safe ordered window equals the plain window, whatever the partitioning,
including one key holding most rows and spanning many partitions."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkrisk.operators.sequence import latest, ordered_window


def _rows(n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else (None if rnd.random() < 0.02 else f"k{rnd.randint(0, 40)}")
        t = None if rnd.random() < 0.03 else rnd.randint(0, 200)
        rows.append((key, t, rnd.randint(0, 5), i, rnd.randint(0, 3)))
    return rows


def _df(spark):
    return spark.createDataFrame(_rows(), "k string, t int, tie int, uid int, v int")


def _collect(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_range_equals_hash_on_hot_key(spark):
    df = _df(spark)
    kw = dict(key="k", time="t", ties=["tie", "uid"], row_number="rn", lags={"prev_t": "t", "prev_v": "v"},
              group_sums={"gs": "v"}, running_sums={"cum": "v"}, null_time_sum=0)
    for parts in (1, 7, 31):
        ranged = ordered_window(df, strategy="range", num_partitions=parts, **kw)
        hashed = ordered_window(df, strategy="hash", **kw)
        cols = ["uid", "rn", "prev_t", "prev_v", "gs", "cum"]
        assert _collect(ranged, cols) == _collect(hashed, cols)


def test_row_numbers_are_one_to_n(spark):
    out = ordered_window(_df(spark), "k", "t", ["tie", "uid"], row_number="rn", num_partitions=13)
    per_key = out.groupBy("k").agg(F.count("*").alias("n"), F.min("rn").alias("lo"), F.max("rn").alias("hi"),
                                   F.count_distinct("rn").alias("d"))
    for r in per_key.collect():
        assert (r.lo, r.hi, r.d) == (1, r.n, r.n)


def test_brute_force_running_sum(spark):
    rows = _rows(800, seed=9)
    out = ordered_window(spark.createDataFrame(rows, "k string, t int, tie int, uid int, v int"),
                         "k", "t", ["tie", "uid"], running_sums={"cum": "v"}, num_partitions=9)
    got = {r.uid: r.cum for r in out.collect()}

    def key(r):
        return (r[1] is not None, r[1] if r[1] is not None else 0, r[2], r[3])

    for k in {r[0] for r in rows}:
        acc = 0
        for r in sorted((r for r in rows if r[0] == k), key=key):
            acc += r[4]
            assert got[r[3]] == acc


def test_latest_equals_row_number_one(spark):
    df = _df(spark)
    w = Window.partitionBy("k").orderBy(F.col("t").desc_nulls_last(), F.col("tie").desc_nulls_last(),
                                        F.col("uid").desc_nulls_last())
    ref = df.withColumn("r", F.row_number().over(w)).filter("r = 1").drop("r")
    got = latest(df, "k", "t", ["tie", "uid"])
    assert _collect(got, ["k", "uid"]) == _collect(ref, ["k", "uid"])


def test_range_layout_splits_a_hot_key(spark):
    """The mechanism the range strategy relies on: a key with 60 % of the rows is cut into
    several ordered ranges and no range is much larger than the average."""
    df = _df(spark).filter(F.col("t").isNotNull())
    ranged = df.repartitionByRange(8, F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first())
    layout = ranged.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count("*").alias("n"), F.count_if(F.col("k") == "hot").alias("hot"))
    rows = layout.collect()
    sizes = [r.n for r in rows]
    assert sum(1 for r in rows if r.hot > 0) >= 4
    assert max(sizes) <= 2.5 * (sum(sizes) / len(sizes))


def _range_sizes(monkeypatch, **kw):
    """Rows per range of the window stage that ``ordered_window`` writes."""
    from sparkrisk.operators import sequence as SQ

    seen = []
    write = SQ.materialize
    monkeypatch.setattr(SQ, "materialize", lambda df, *a: seen.append(write(df, *a)) or seen[-1])
    out = ordered_window(**kw)
    return out, [r["count"] for r in seen[0].groupBy("__seq_pid").count().collect()]


def test_hot_key_without_times_is_split(spark, monkeypatch):
    df = spark.range(40_000).selectExpr("'hot' AS k", "CAST(NULL AS INT) AS t", "id AS uid", "1 AS v")
    out, sizes = _range_sizes(monkeypatch, df=df, key="k", time="t", ties=["uid"], row_number="rn", group_sums={"g": "v"},
                              null_time_sum=0, lags={"before": "uid"}, num_partitions=8)
    assert len(sizes) == 8 and max(sizes) < 7000
    assert out.filter("rn <> uid + 1 OR g <> 0 OR before <> uid - 1 OR (uid > 0 AND before IS NULL)").count() == 0


def test_hot_visit_is_split(spark, monkeypatch):
    """One (key, time) group with most rows is cut into ranges; its sum, and the lag of that sum on
    the next row, are the whole group's."""
    df = spark.range(40_000).selectExpr(
        "IF(id % 4 < 3, 'hot', CAST(id % 40 AS STRING)) AS k", "IF(id % 4 < 3, IF(id = 2, 9, 5), CAST(id % 7 AS INT)) AS t",
        "id AS uid", "id % 3 AS v")
    kw = dict(key="k", time="t", ties=["uid"], row_number="rn", group_sums={"g": "v"}, null_time_sum=0,
              lags={"last_g": "g", "last_t": "t"})
    out, sizes = _range_sizes(monkeypatch, df=df, num_partitions=8, **kw)
    assert len(sizes) == 8 and max(sizes) < 7000
    cols = ["uid", "rn", "g", "last_g", "last_t"]
    assert _collect(out, cols) == _collect(ordered_window(df, strategy="hash", **kw), cols)
    assert out.filter("k = 'hot' AND t = 9").first()["last_g"] == df.filter("k = 'hot' AND t = 5").agg(F.sum("v")).first()[0]


def test_group_sums_over_many_ranges(spark):
    """Groups longer than several ranges, null keys and times, null values, and no other column asked for."""
    rows = [(None if i % 11 == 0 else i % 2, None if i % 13 == 0 else i % 3, i, None if i % 5 == 0 else i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, t int, uid int, v int")
    for parts in (1, 5, 40):
        kw = dict(key="k", time="t", ties=["uid"], group_sums={"g": "v", "h": "uid"}, null_time_sum=-1)
        assert (_collect(ordered_window(df, num_partitions=parts, **kw), ["uid", "g", "h"])
                == _collect(ordered_window(df, strategy="hash", **kw), ["uid", "g", "h"]))
        kw["lags"] = {"lg": "g", "lh": "h"}
        assert (_collect(ordered_window(df, num_partitions=parts, **kw), ["uid", "g", "lg", "lh"])
                == _collect(ordered_window(df, strategy="hash", **kw), ["uid", "g", "lg", "lh"]))


def test_equal_counts_are_split(spark, monkeypatch):
    df = spark.range(40_000).selectExpr("0 AS k", "-1 AS t", "CAST(id AS STRING) AS value")
    out, sizes = _range_sizes(monkeypatch, df=df, key="k", time="t", ties=["value"], row_number="rn", num_partitions=8)
    assert len(sizes) == 8 and max(sizes) < 7000
    assert out.agg(F.count_distinct("rn"), F.max("rn")).first() == (40_000, 40_000)


def test_short_keys_need_no_aggregate(spark):
    df = spark.range(5000).selectExpr("CAST(id AS STRING) AS k", "1 AS t", "id AS uid", "2 AS v")
    out = ordered_window(df, "k", "t", ["uid"], row_number="rn", running_sums={"cum": "v"}, num_partitions=6)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert out.filter("rn <> 1 OR cum <> 2").count() == 0
