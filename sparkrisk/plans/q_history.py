"""Checked queries for the history and scoring-feature operators (W, A1-A2, J1-J2, C3, C5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk import fixtures as FX
from sparkrisk.functions import scalar as S
from sparkrisk.operators import clean as C
from sparkrisk.operators import history as H
from sparkrisk.operators.sequence import latest, ordered_window
from sparkrisk.plans.registry import query
from sparkrisk.plans.sql import (
    CTE_EVENTS,
    CTE_FEATURES,
    CTE_HISTORY,
    CTE_HISTORY_HOT,
    CTE_HISTORY_HOT_VISIT,
    HIST_ORDER,
    HOT_KEY_SQL,
    HOT_VISIT,
    LATEST_ORDER,
)

TUPLE = [H.KEY, H.TIME, *H.TIES]
TUPLE_SQL = ", ".join(TUPLE)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inspection records with the event time parsed from text."""
    fx = FX.fx_inspections(spark, sf_dir)
    return fx.withColumn(H.TIME, S.parse_time("resultdttm_raw"))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = C.clean_events(events(spark, sf_dir))
    return C.clean_city(ev, stage="train", lower_cols=("state",))


def distinct_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select(*TUPLE).distinct()


def history(spark: SparkSession, sf_dir: str, strategy: str = "range") -> DataFrame:
    return H.build_history(events(spark, sf_dir), strategy=strategy)


def features(spark: SparkSession, sf_dir: str, hist: DataFrame | None = None) -> DataFrame:
    hist = history(spark, sf_dir) if hist is None else hist
    return H.latest_features(hist, FX.fx_establishments(spark, sf_dir), as_of=FX.AS_OF)


@query("C3_build_history", f"WITH {CTE_HISTORY} SELECT * FROM hist")
def c3_build_history(spark, sf_dir):
    """Flagship: the full history table."""
    return history(spark, sf_dir)


def hot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with one entity holding about a third of them (ids divisible by 3
    become '0'): the case the skew-safe window is built for."""
    return events(spark, sf_dir).withColumn(H.KEY, F.expr(HOT_KEY_SQL))


@query("C3_build_history_hot_entity", f"WITH {CTE_HISTORY_HOT} SELECT * FROM hist")
def c3_build_history_hot_entity(spark, sf_dir):
    """C3 when one entity holds a third of all rows."""
    return H.build_history(hot_events(spark, sf_dir))


@query("W4_hot_visit", f"WITH {CTE_HISTORY_HOT_VISIT} SELECT * FROM hist")
def w4_hot_visit(spark, sf_dir):
    """C3 when one visit (entity and time) holds a third of all rows: its counts and the counts that
    the next rows take from it are added up over the ranges it spans."""
    rows = events(spark, sf_dir)
    hot = F.lit(HOT_VISIT).cast(rows.schema[H.TIME].dataType)
    rows = rows.withColumn(H.TIME, F.when(F.col(H.KEY).cast("bigint") % 3 == 0, hot).otherwise(F.col(H.TIME)))
    return H.build_history(rows.withColumn(H.KEY, F.expr(HOT_KEY_SQL)))


@query("C5_latest_features", f"WITH {CTE_FEATURES} SELECT * FROM feat")
def c5_latest_features(spark, sf_dir):
    return features(spark, sf_dir)


@query(
    "W1_ordinal",
    f"WITH {CTE_EVENTS}, d AS (SELECT DISTINCT {TUPLE_SQL} FROM ev) "
    f"SELECT *, row_number() OVER ({HIST_ORDER}) AS inspections_so_far FROM d",
)
def w1_ordinal(spark, sf_dir):
    d = distinct_tuples(spark, sf_dir)
    return ordered_window(d, H.KEY, H.TIME, H.TIES, row_number="inspections_so_far")


@query(
    "W2_previous_time",
    f"WITH {CTE_EVENTS}, d AS (SELECT DISTINCT {TUPLE_SQL} FROM ev) "
    f"SELECT *, lag(resultdttm) OVER ({HIST_ORDER}) AS last_inspections FROM d",
)
def w2_previous_time(spark, sf_dir):
    d = distinct_tuples(spark, sf_dir)
    return ordered_window(d, H.KEY, H.TIME, H.TIES, lags={"last_inspections": H.TIME})


@query(
    "W3_gap_days",
    f"WITH {CTE_EVENTS}, d AS (SELECT DISTINCT {TUPLE_SQL} FROM ev) "
    f"SELECT {TUPLE_SQL}, CAST(coalesce(date_diff('day', lag(resultdttm) OVER ({HIST_ORDER}), resultdttm), "
    f"99999999) AS INTEGER) AS days_since_last_inspect FROM d",
)
def w3_gap_days(spark, sf_dir):
    d = distinct_tuples(spark, sf_dir)
    w = ordered_window(d, H.KEY, H.TIME, H.TIES, lags={"__prev": H.TIME})
    days = F.coalesce(S.days_between(H.TIME, "__prev"), F.lit(99999999))
    return w.select(*TUPLE, days.alias("days_since_last_inspect"))


@query(
    "W4_previous_counts",
    f"WITH {CTE_HISTORY} SELECT {TUPLE_SQL}, viol_fail, viol_pass, last_viol_fail, last_viol_pass FROM hist",
)
def w4_previous_counts(spark, sf_dir):
    return history(spark, sf_dir).select(*TUPLE, "viol_fail", "viol_pass", "last_viol_fail", "last_viol_pass")


@query(
    "W5_latest",
    f"WITH {CTE_HISTORY} SELECT * EXCLUDE (rn) FROM "
    f"(SELECT *, row_number() OVER ({LATEST_ORDER}) AS rn FROM hist) WHERE rn = 1",
)
def w5_latest(spark, sf_dir):
    h = history(spark, sf_dir)
    return latest(h, H.KEY, H.TIME, H.TIES).select(*h.columns)


@query(
    "A1_group_count",
    f"WITH {CTE_EVENTS} SELECT property_id, resultdttm, count(*) AS count FROM ev GROUP BY property_id, resultdttm",
)
def a1_group_count(spark, sf_dir):
    return cleaned(spark, sf_dir).groupBy(H.KEY, H.TIME).count()


_PIVOT_SQL = (
    "SELECT property_id, resultdttm, "
    "nullif(count(*) FILTER (WHERE violstatus = 'Fail'), 0) AS viol_fail, "
    "nullif(count(*) FILTER (WHERE violstatus = 'Pass'), 0) AS viol_pass "
    "FROM ev GROUP BY property_id, resultdttm"
)


@query("A2_pivot_count", f"WITH {CTE_EVENTS} {_PIVOT_SQL}")
def a2_pivot_count(spark, sf_dir):
    return H.pivot_count(cleaned(spark, sf_dir), [H.KEY, H.TIME], H.STATUS, H.OUTCOMES)


@query(
    "A2_pivot_all_values",
    f"WITH {FX.CTE_INSPECTIONS} SELECT property_id, "
    "nullif(count(*) FILTER (WHERE violstatus IS NULL), 0) AS \"null\", "
    "nullif(count(*) FILTER (WHERE violstatus = ' '), 0) AS \" \", "
    "nullif(count(*) FILTER (WHERE violstatus = 'Fail'), 0) AS \"Fail\", "
    "nullif(count(*) FILTER (WHERE violstatus = 'Pass'), 0) AS \"Pass\" "
    "FROM fx_inspections GROUP BY property_id",
)
def a2_pivot_all_values(spark, sf_dir):
    """Every status of every raw record, found in a first pass, as a column per entity."""
    return H.pivot_all(events(spark, sf_dir), [H.KEY], H.STATUS)


@query(
    "J1_attach_counts",
    f"WITH {CTE_EVENTS}, d AS (SELECT DISTINCT {TUPLE_SQL} FROM ev), v AS ({_PIVOT_SQL}) "
    "SELECT d.*, v.viol_fail, v.viol_pass FROM d LEFT JOIN v "
    "ON d.property_id = v.property_id AND d.resultdttm = v.resultdttm",
)
def j1_attach_counts(spark, sf_dir):
    c = cleaned(spark, sf_dir)
    counts = H.pivot_count(c, [H.KEY, H.TIME], H.STATUS, H.OUTCOMES)
    return H.attach_counts(c.select(*TUPLE).distinct(), counts, [H.KEY, H.TIME])


@query(
    "J2_attach_latest",
    f"WITH {CTE_FEATURES} SELECT ents.*, lt.inspections_so_far, lt.days_since_last_inspect, "
    "lt.last_viol_fail, lt.last_viol_pass FROM ents LEFT JOIN lt ON ents.property_id = lt.property_id",
)
def j2_attach_latest(spark, sf_dir):
    last = H.latest_state(history(spark, sf_dir), as_of=FX.AS_OF)
    ents = C.clean_city(C.rename(FX.fx_establishments(spark, sf_dir), H.ENTITY_RENAMES), stage="score")
    return H.attach_latest(ents, last)
