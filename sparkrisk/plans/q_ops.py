"""Checked queries for projections, filters, scalar functions, sets and limits
(P1-P11, F1-F8, U1-U2, C2, O1, C7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sparkrisk import fixtures as FX
from sparkrisk.functions import scalar as S
from sparkrisk.operators import clean as C
from sparkrisk.operators import history as H
from sparkrisk.plans import q_history as QH
from sparkrisk.plans.registry import query
from sparkrisk.plans.sql import CTE_EVENTS, CTE_HISTORY, HIST_ORDER
from sparkrisk.schemas import DEFAULT_CITY, DEFAULT_ZIP

INS = f"WITH {FX.CTE_INSPECTIONS} "
EST = f"WITH {FX.CTE_ESTABLISHMENTS} "


def _ins(spark, sf_dir):
    return FX.fx_inspections(spark, sf_dir)


def _est(spark, sf_dir):
    return FX.fx_establishments(spark, sf_dir)


@query(
    "P1_clean_events",
    INS + "SELECT * FROM fx_inspections WHERE viollevel <> '1919' AND property_id IS NOT NULL AND violstatus <> ' '",
)
def p1_clean_events(spark, sf_dir):
    return C.clean_events(_ins(spark, sf_dir))


@query("P2_select", INS + "SELECT _id, property_id, resultdttm, city FROM fx_inspections")
def p2_select(spark, sf_dir):
    return C.select_columns(_ins(spark, sf_dir), ["_id", "property_id", "resultdttm", "city"])


@query("P3_drop", INS + "SELECT * EXCLUDE (location, resultdttm_raw) FROM fx_inspections")
def p3_drop(spark, sf_dir):
    return C.drop_columns(_ins(spark, sf_dir), ["location", "resultdttm_raw", "not_a_column"])


@query(
    "P4_rename",
    EST + "SELECT _id, Property_ID AS pid, BusinessName, State, LICENSECAT, DESCRIPT, CITY AS town, ZIP "
    "FROM fx_establishments",
)
def p4_rename(spark, sf_dir):
    return C.rename(_est(spark, sf_dir), {"property_id": "pid", "city": "town", "absent": "x"})


@query(
    "P5_default_nulls",
    INS + "SELECT _id, coalesce(city, 'boston') AS city, coalesce(zip, '02116') AS zip FROM fx_inspections",
)
def p5_default_nulls(spark, sf_dir):
    df = _ins(spark, sf_dir).select("_id", "city", "zip")
    return C.default_nulls(df, {"city": DEFAULT_CITY, "zip": DEFAULT_ZIP})


@query(
    "P6_default_blanks",
    EST + "SELECT _id, CASE WHEN CITY IN ('', ' ') THEN 'boston' ELSE CITY END AS CITY FROM fx_establishments",
)
def p6_default_blanks(spark, sf_dir):
    return C.default_blanks(_est(spark, sf_dir).select("_id", "CITY"), {"CITY": DEFAULT_CITY})


_PIVOT = (
    "SELECT property_id, resultdttm, "
    "nullif(count(*) FILTER (WHERE violstatus = 'Fail'), 0) AS viol_fail, "
    "nullif(count(*) FILTER (WHERE violstatus = 'Pass'), 0) AS viol_pass "
    "FROM ev GROUP BY property_id, resultdttm"
)


@query(
    "P7_label",
    f"WITH {CTE_EVENTS}, v AS ({_PIVOT}) "
    "SELECT *, CASE WHEN viol_fail > 0 THEN 1 ELSE 0 END AS fail FROM v",
)
def p7_label(spark, sf_dir):
    counts = H.pivot_count(QH.cleaned(spark, sf_dir), [H.KEY, H.TIME], H.STATUS, H.OUTCOMES)
    return C.label(counts)


@query(
    "P8_to_int",
    INS + "SELECT _id, TRY_CAST(zip AS INTEGER) AS zip, TRY_CAST(property_id AS INTEGER) AS property_id, "
    "TRY_CAST(resultdttm_raw AS INTEGER) AS resultdttm_raw FROM fx_inspections",
)
def p8_to_int(spark, sf_dir):
    df = _ins(spark, sf_dir).select("_id", "zip", "property_id", "resultdttm_raw")
    return C.to_int(df, ["zip", "property_id", "resultdttm_raw"])


@query(
    "P9_fill_numeric",
    f"WITH {CTE_EVENTS}, v AS ({_PIVOT}) "
    "SELECT property_id, resultdttm, coalesce(viol_fail, 0) AS viol_fail, coalesce(viol_pass, 0) AS viol_pass FROM v",
)
def p9_fill_numeric(spark, sf_dir):
    counts = H.pivot_count(QH.cleaned(spark, sf_dir), [H.KEY, H.TIME], H.STATUS, H.OUTCOMES)
    return C.fill_numeric(counts, 0)


@query(
    "P10_numeric_columns",
    f"WITH {CTE_HISTORY} SELECT inspections_so_far, days_since_last_inspect, viol_fail, viol_pass, fail, "
    "last_viol_fail, last_viol_pass FROM hist",
)
def p10_numeric_columns(spark, sf_dir):
    return C.split_by_type(QH.history(spark, sf_dir))[1]


@query(
    "P10_categorical_columns",
    f"WITH {CTE_HISTORY} SELECT property_id, resultdttm, issdttm, state, location, licensecat, descript, "
    "city, zip, last_inspections FROM hist",
)
def p10_categorical_columns(spark, sf_dir):
    return C.split_by_type(QH.history(spark, sf_dir))[0]


@query("P11_features", f"WITH {CTE_HISTORY} SELECT * EXCLUDE (fail) FROM hist")
def p11_features(spark, sf_dir):
    return C.features_and_target(QH.history(spark, sf_dir))[0]


@query("P11_target", f"WITH {CTE_HISTORY} SELECT fail FROM hist")
def p11_target(spark, sf_dir):
    return C.features_and_target(QH.history(spark, sf_dir))[1]


@query(
    "C2_clean_city_train",
    INS + "SELECT _id, replace(replace(coalesce(lower(city), 'boston'), '/', ''), '  ', ' ') AS city, "
    "coalesce(zip, '02116') AS zip, lower(state) AS state FROM fx_inspections",
)
def c2_clean_city_train(spark, sf_dir):
    df = _ins(spark, sf_dir).select("_id", "city", "zip", "state")
    return C.clean_city(df, stage="train", lower_cols=("state",))


@query(
    "C2_clean_city_score",
    EST + "SELECT _id, CASE WHEN c2 IN ('', ' ') THEN 'boston' ELSE c2 END AS city, "
    "coalesce(ZIP, '02116') AS zip FROM (SELECT *, "
    "replace(replace(replace(lower(CITY), '/', ''), 'downtownfinancial', 'financial'), '  ', ' ') AS c2 "
    "FROM fx_establishments)",
)
def c2_clean_city_score(spark, sf_dir):
    df = C.rename(_est(spark, sf_dir).select("_id", "CITY", "ZIP"), H.ENTITY_RENAMES)
    return C.clean_city(df, stage="score")


@query("F1_lower", EST + "SELECT _id, lower(CITY) AS city FROM fx_establishments")
def f1_lower(spark, sf_dir):
    return _est(spark, sf_dir).select("_id", S.lower_text("CITY").alias("city"))


@query("F2_remove_slashes", EST + "SELECT _id, replace(CITY, '/', '') AS city FROM fx_establishments")
def f2_remove_slashes(spark, sf_dir):
    return _est(spark, sf_dir).select("_id", S.remove_slashes("CITY").alias("city"))


@query(
    "F3_collapse_spaces",
    EST + "SELECT _id, replace(CITY || '   x', '  ', ' ') AS city FROM fx_establishments",
)
def f3_collapse_spaces(spark, sf_dir):
    # The appended three spaces check the single-pass rule: they become two.
    return _est(spark, sf_dir).select(
        "_id", S.collapse_double_spaces(F.concat("CITY", F.lit("   x"))).alias("city")
    )


@query(
    "F4_alias_fix",
    EST + "SELECT _id, replace(replace(lower(CITY), '/', ''), 'downtownfinancial', 'financial') AS city "
    "FROM fx_establishments",
)
def f4_alias_fix(spark, sf_dir):
    c = S.replace_text(S.remove_slashes(S.lower_text("CITY")), *C.CITY_ALIAS)
    return _est(spark, sf_dir).select("_id", c.alias("city"))


@query(
    "F5_parse_time",
    INS + "SELECT _id, try_strptime(resultdttm_raw, '%Y-%m-%d %H:%M:%S') AS resultdttm FROM fx_inspections",
)
def f5_parse_time(spark, sf_dir):
    return _ins(spark, sf_dir).select("_id", S.parse_time("resultdttm_raw").alias("resultdttm"))


@query(
    "F6_days_between",
    INS + "SELECT _id, CAST(date_diff('day', issdttm, resultdttm) AS INTEGER) AS days FROM fx_inspections",
)
def f6_days_between(spark, sf_dir):
    return _ins(spark, sf_dir).select("_id", S.days_between("resultdttm", "issdttm").alias("days"))


@query(
    "F7_as_of",
    INS + f"SELECT _id, CAST(date_diff('day', resultdttm, DATE '{FX.AS_OF}') AS INTEGER) AS days "
    "FROM fx_inspections",
)
def f7_as_of(spark, sf_dir):
    return _ins(spark, sf_dir).select("_id", S.days_between(S.as_of_date(FX.AS_OF), "resultdttm").alias("days"))


@query(
    "F8_predicates",
    INS + "SELECT _id, viollevel <> '1919' AS level_ok, property_id IS NULL AS no_key, "
    "violstatus = 'Fail' AS is_fail, CASE WHEN viollevel = '***' THEN 'high' ELSE 'low' END AS grade, "
    "'x' AS tag FROM fx_inspections",
)
def f8_predicates(spark, sf_dir):
    return _ins(spark, sf_dir).select(
        "_id",
        (F.col("viollevel") != "1919").alias("level_ok"),
        F.col("property_id").isNull().alias("no_key"),
        (F.col("violstatus") == "Fail").alias("is_fail"),
        F.when(F.col("viollevel") == "***", "high").otherwise("low").alias("grade"),
        F.lit("x").alias("tag"),
    )


def union_pages(dfs):
    """Union by position, duplicates kept, pages appended in order."""
    return reduce(lambda a, b: a.unionAll(b), dfs)


@query(
    "U1_union_pages",
    INS + "SELECT _id, property_id, violstatus FROM fx_inspections UNION ALL "
    "SELECT _id, property_id, violstatus FROM fx_inspections",
)
def u1_union_pages(spark, sf_dir):
    df = _ins(spark, sf_dir).select("_id", "property_id", "violstatus")
    return union_pages([df, df])


@query("U2_distinct", f"WITH {CTE_EVENTS} SELECT DISTINCT {QH.TUPLE_SQL} FROM ev")
def u2_distinct(spark, sf_dir):
    return QH.distinct_tuples(spark, sf_dir)


def head_rows(df, n, order):
    """O1: first ``n`` rows in a total order (a top-n report)."""
    return df.orderBy(*order).limit(n)


def _hist_sort():
    return [F.col(c).asc_nulls_first() for c in QH.TUPLE]


@query(
    "O1_head_rows",
    f"WITH {CTE_HISTORY} SELECT * FROM hist ORDER BY {HIST_ORDER.replace('PARTITION BY property_id ORDER BY ', 'property_id NULLS FIRST, ')} LIMIT 10",
)
def o1_head_rows(spark, sf_dir):
    return head_rows(QH.history(spark, sf_dir), 10, _hist_sort())


@query(
    "C7_review_history",
    f"WITH {CTE_HISTORY} SELECT * FROM hist ORDER BY {HIST_ORDER.replace('PARTITION BY property_id ORDER BY ', 'property_id NULLS FIRST, ')} LIMIT 10",
)
def c7_review_history(spark, sf_dir):
    """The review query over the history table, run through a temp view as SQL."""
    QH.history(spark, sf_dir).createOrReplaceTempView("inspections_historic")
    order = ", ".join(f"{c} NULLS FIRST" for c in QH.TUPLE)
    return spark.sql(f"SELECT * FROM inspections_historic ORDER BY {order} LIMIT 10")
