"""Hand-written rows for the history and scoring operators."""

import datetime as dt

from sparkrisk.operators import clean as C
from sparkrisk.operators import history as H

SCHEMA = ("property_id string, resultdttm timestamp_ntz, issdttm timestamp_ntz, state string, location string, "
          "licensecat string, descript string, city string, zip string, violstatus string, viollevel string")


def d(day):
    return dt.datetime(2020, 1, day)


def _events(spark):
    rows = [
        # one entity, one event: previous values get the first-event fill
        ("solo", d(1), d(1), "MA", "l", "FS", "x", "Old Town", "02115", "Fail", "*"),
        # two rows with the same key and time but another issue date: two history rows
        ("tie", d(1), d(1), "MA", "l", "FS", "x", "a/b  c", None, "Fail", "*"),
        ("tie", d(1), d(2), "MA", "l", "FS", "x", "a/b  c", None, "Pass", "*"),
        # a null time, then a real event after it
        ("nt", None, d(1), "MA", "l", "FS", "x", None, "1", "Fail", "*"),
        ("nt", d(5), d(1), "MA", "l", "FS", "x", "Town   X", "1", "Pass", "*"),
        # rows the filter drops: excluded level, null level, blank status, null status, null key
        ("drop", d(1), d(1), "MA", "l", "FS", "x", "c", "1", "Fail", "1919"),
        ("drop", d(2), d(1), "MA", "l", "FS", "x", "c", "1", "Fail", None),
        ("drop", d(3), d(1), "MA", "l", "FS", "x", "c", "1", " ", "*"),
        ("drop", d(4), d(1), "MA", "l", "FS", "x", "c", "1", None, "*"),
        (None, d(4), d(1), "MA", "l", "FS", "x", "c", "1", "Fail", "*"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_history_edge_rows(spark):
    rows = H.build_history(_events(spark)).collect()
    hist = {(r.property_id, r.issdttm): r for r in rows if r.property_id != "nt"}
    assert {r.property_id for r in rows} == {"solo", "tie", "nt"}
    solo = hist[("solo", d(1))]
    assert (solo.inspections_so_far, solo.days_since_last_inspect, solo.last_viol_fail) == (1, 99999999, 99999999)
    assert solo.fail == 1 and solo.city == "old town"
    t1, t2 = hist[("tie", d(1))], hist[("tie", d(2))]
    # both rows of the visit carry the visit's counts; ties ordered by issue date
    assert (t1.viol_fail, t1.viol_pass, t2.viol_fail, t2.viol_pass) == (1, 1, 1, 1)
    assert (t1.inspections_so_far, t2.inspections_so_far) == (1, 2)
    assert t2.days_since_last_inspect == 0 and t2.last_viol_fail == 1
    assert t1.city == "ab c" and t1.zip == "02116"
    first, second = sorted((r for r in rows if r.property_id == "nt"), key=lambda r: r.inspections_so_far)
    assert first.resultdttm is None and first.viol_fail == 0 and first.fail == 0
    assert first.city == "boston"
    # the event after a null time: previous time null, so the gap is the fill; counts lag is 0
    assert second.last_inspections is None and second.days_since_last_inspect == 99999999
    assert second.last_viol_fail == 0 and second.city == "town  x"


def test_latest_features_entities_without_events(spark):
    hist = H.build_history(_events(spark))
    ents = spark.createDataFrame(
        [(1, "solo", "", None), (2, "none", "Downtown/Financial", "1"), (3, "tie", " ", "2")],
        "_id int, Property_ID string, CITY string, ZIP string",
    )
    out = {r.property_id: r for r in H.latest_features(hist, ents, as_of="2020-02-01").collect()}
    assert out["none"].inspections_so_far == 0 and out["none"].days_since_last_inspect == 99999999
    assert out["none"].city == "financial"
    assert out["solo"].city == "boston" and out["solo"].zip == "02116" and out["solo"].days_since_last_inspect == 31
    assert out["tie"].inspections_so_far == 2 and out["tie"].last_viol_pass == 1 and out["tie"].city == "boston"


def test_rename_is_case_insensitive_and_ignores_absent(spark):
    df = spark.createDataFrame([(1, "a")], "Property_ID int, CITY string")
    assert C.rename(df, {"property_id": "p", "nope": "x"}).columns == ["p", "CITY"]


def test_to_int_bad_text_is_null(spark):
    df = spark.createDataFrame([("12",), ("x",), (None,)], "v string")
    assert [r.v for r in C.to_int(df, ["v"]).collect()] == [12, None, None]


def test_joins_keep_left_rows(spark):
    hist = H.build_history(_events(spark))
    counts = H.pivot_count(C.clean_events(_events(spark)), ["property_id", "resultdttm"], "violstatus", H.OUTCOMES)
    left = hist.select("property_id", "resultdttm", "issdttm")
    assert H.attach_counts(left, counts, ["property_id", "resultdttm"]).count() == left.count()
    ents = spark.createDataFrame([("solo",), ("none",), ("tie",)], "property_id string")
    latest_rows = hist.groupBy("property_id").count()
    assert H.attach_latest(ents, latest_rows).count() == 3


def test_describe_all_exact_percentiles(spark):
    from sparkrisk.operators.profile import describe_all

    df = spark.createDataFrame([(i % 7 if i % 5 else None, f"w{i % 3}", float(-i)) for i in range(200)], "a int, b string, c double")
    got = {r.feature: r for r in describe_all(df.repartition(9)).collect()}
    assert set(got) == {"a", "b", "c"} and got["b"].top == "w0" and got["b"].p50 is None
    for name, values in (("a", [i % 7 for i in range(200) if i % 5]), ("c", [float(-i) for i in range(200)])):
        values.sort()
        want = [values[-(-len(values) * p // 100) - 1] for p in (25, 50, 75)]
        assert [got[name][f"p{p}"] for p in (25, 50, 75)] == want
        assert got[name]["count"] == len(values)
    assert got["a"].unique == 7 and got["c"].min == -199


def test_pivot_keeps_columns_for_absent_values(spark):
    """Explicit values: a status that never occurs still gives its column (all null), and an
    unexpected status gives none."""
    df = spark.createDataFrame([("k", 1, "Pass"), ("k", 1, "Pass"), ("k", 2, "Other")], "p string, t int, s string")
    out = H.pivot_count(df, ["p", "t"], "s", {"viol_fail": "Fail", "viol_pass": "Pass"})
    assert out.columns == ["p", "t", "viol_fail", "viol_pass"]
    rows = {r.t: (r.viol_fail, r.viol_pass) for r in out.collect()}
    assert rows == {1: (None, 2), 2: (None, None)}


def test_ordered_outputs(spark):
    from sparkrisk.operators.profile import profile, value_counts
    from sparkrisk.plans.q_ops import head_rows

    df = spark.createDataFrame([("b", None), ("a", 1), ("b", 2), ("c", None), ("a", None), ("b", 3)], "v string, n int")
    assert [(r.value, r["count"]) for r in value_counts(df, "v").collect()] == [("b", 3), ("a", 2), ("c", 1)]
    assert [r.feature for r in profile(df).collect()] == ["n", "v"]  # most missing first
    assert [r.n for r in head_rows(df.filter("n IS NOT NULL"), 2, ["n"]).collect()] == [1, 2]
