"""Model scores equal those computed anew from the saved nodes, and a broken model is noticed."""

import pytest
from conftest import SF_SMALL
from oracle import compare
from pyspark.sql import functions as F

import __spark_entry__ as E
from sparkrisk.ml import model as MD
from sparkrisk.session import stage_scope


@pytest.mark.parametrize("key", ["M6_M8_forest_values", "M14_gbt_values", "C6_risk_values"])
def test_values_agree(spark, key):
    with stage_scope(spark):
        rows = E.queries()[key](spark, SF_SMALL).collect()
    assert len(rows) > 50 and len({round(r.proba, 6) for r in rows}) > 5
    assert max(abs(r.proba - r.recomputed) for r in rows) < 1e-9


def test_a_broken_model_fails_the_key(spark, monkeypatch):
    """Scores that do not come from the features the row has are other than those of the nodes."""
    whole = MD.score

    def broken(model, df):
        kept = whole(model, df).drop("probability")
        other = whole(model, df.withColumn("last_viol_fail", F.lit(0)).withColumn("inspections_so_far", F.lit(1)))
        # The same rows in the same order: both frames are the same narrow steps over one table.
        index = F.monotonically_increasing_id()
        return kept.withColumn("__n", index).join(other.select(index.alias("__n"), "probability"), "__n").drop("__n")

    monkeypatch.setattr(MD, "score", broken)
    with stage_scope(spark):
        df = E.queries()["M6_M8_forest_scores"](spark, SF_SMALL)
        ok, msg = compare(df, E.oracle_sql()["M6_M8_forest_scores"], SF_SMALL)
    assert not ok and "values differ" in msg
