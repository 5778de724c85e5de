"""Checked queries for profiles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkrisk import fixtures as FX
from sparkrisk.operators import profile as PR
from sparkrisk.plans import q_history as QH
from sparkrisk.plans.registry import query
from sparkrisk.plans.sql import CTE_HISTORY

INS = f"WITH {FX.CTE_INSPECTIONS} "

# Column types of fx_inspections as Spark names them (metadata the oracle restates).
FX_TYPES = {
    "_id": "bigint",
    "property_id": "string",
    "resultdttm": "timestamp_ntz",
    "issdttm": "timestamp_ntz",
    "resultdttm_raw": "string",
    "state": "string",
    "location": "string",
    "licensecat": "string",
    "descript": "string",
    "city": "string",
    "zip": "string",
    "result": "string",
    "violstatus": "string",
    "viollevel": "string",
}

HIST_NUMERIC = ["inspections_so_far", "days_since_last_inspect", "viol_fail", "viol_pass", "fail",
                "last_viol_fail", "last_viol_pass"]
HIST_OTHER = ["property_id", "resultdttm", "issdttm", "state", "location", "licensecat", "descript",
              "city", "zip", "last_inspections"]


@query("A3_row_count", INS + "SELECT count(*) AS rows, count(*) = 0 AS is_empty FROM fx_inspections")
def a3_row_count(spark, sf_dir):
    return PR.row_count(FX.fx_inspections(spark, sf_dir))


@query("A4_shape", f"WITH {CTE_HISTORY} SELECT count(*) AS rows, 17 AS columns FROM hist")
def a4_shape(spark, sf_dir):
    return PR.shape(QH.history(spark, sf_dir))


@query("A5_value_counts", f"WITH {CTE_HISTORY} SELECT fail AS value, count(*) AS count FROM hist GROUP BY fail")
def a5_value_counts(spark, sf_dir):
    return PR.value_counts(QH.history(spark, sf_dir), "fail")


@query(
    "A5_value_counts_status",
    INS + "SELECT violstatus AS value, count(*) AS count FROM fx_inspections "
    "WHERE violstatus IS NOT NULL GROUP BY violstatus",
)
def a5_value_counts_status(spark, sf_dir):
    return PR.value_counts(FX.fx_inspections(spark, sf_dir), "violstatus")


def _profile_sql():
    parts = [
        f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS classes, '{t}' AS datatype, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS missing, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*) AS missing_percent FROM fx_inspections"
        for c, t in FX_TYPES.items()
    ]
    return INS + " UNION ALL ".join(parts)


@query("A6_profile", _profile_sql())
def a6_profile(spark, sf_dir):
    return PR.profile(FX.fx_inspections(spark, sf_dir))


def _describe_sql():
    parts = []
    for c in HIST_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS feature, count({c}) AS count, count(DISTINCT {c}) AS unique, "
            f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, min({x}) AS min, quantile_disc({x}, 0.25) AS p25, "
            f"quantile_disc({x}, 0.5) AS p50, quantile_disc({x}, 0.75) AS p75, max({x}) AS max FROM hist"
        )
    for c in HIST_OTHER:
        best = (
            f"(SELECT v FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM hist "
            f"WHERE {c} IS NOT NULL GROUP BY v) ORDER BY n DESC, v LIMIT 1)"
        )
        freq = (
            f"(SELECT max(n) FROM (SELECT count(*) AS n FROM hist WHERE {c} IS NOT NULL GROUP BY {c}))"
        )
        parts.append(
            f"SELECT '{c}' AS feature, count({c}) AS count, count(DISTINCT {c}) AS unique, {best} AS top, "
            f"{freq} AS freq, CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, "
            "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS p25, CAST(NULL AS DOUBLE) AS p50, "
            f"CAST(NULL AS DOUBLE) AS p75, CAST(NULL AS DOUBLE) AS max FROM hist"
        )
    return f"WITH {CTE_HISTORY} " + " UNION ALL ".join(parts)


@query("A7_describe_all", _describe_sql())
def a7_describe_all(spark, sf_dir):
    return PR.describe_all(QH.history(spark, sf_dir), digits=6)


def _corr_sql():
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    parts = [
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in cols for b in cols
    ]
    return " UNION ALL ".join(parts)


@query("A8_corr_matrix", _corr_sql())
def a8_corr_matrix(spark, sf_dir):
    li = FX.table(spark, sf_dir, "lineitem")
    return PR.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query(
    "A8_corr_matrix_history",
    f"WITH {CTE_HISTORY} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM hist"
        for a in ("inspections_so_far", "days_since_last_inspect", "viol_fail", "fail")
        for b in ("inspections_so_far", "days_since_last_inspect", "viol_fail", "fail")
    ),
)
def a8_corr_matrix_history(spark, sf_dir):
    cols = ["inspections_so_far", "days_since_last_inspect", "viol_fail", "fail"]
    return PR.corr_matrix(QH.history(spark, sf_dir), cols)



@query("O2_profile_sorted", f"SELECT CAST(row_number() OVER (ORDER BY missing DESC, feature) AS INTEGER) AS position, feature, missing "
       f"FROM ({_profile_sql()})")
def o2_profile_sorted(spark, sf_dir):
    """The order of the profile: each column's position by missing count, largest first."""
    rows = PR.profile(FX.fx_inspections(spark, sf_dir)).select("feature", "missing")
    w = Window.orderBy(F.col("missing").desc(), "feature")  # one row per column of the table
    return rows.select(F.row_number().over(w).alias("position"), "feature", "missing")
