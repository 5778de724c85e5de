"""Every query with an oracle gives the oracle's rows (small scale; the driver and
tests/check_all.py run the same at sf0.01)."""

import pytest
from conftest import SF_SMALL
from oracle import compare

import __spark_entry__ as E
from sparkrisk.session import stage_scope

SQL = E.oracle_sql()


def test_contract_keys():
    qs = E.queries()
    assert set(SQL) <= set(qs)
    assert len(qs) >= 90


def test_entry_runs(spark):
    from sparkrisk.schemas import HISTORY

    df = E.entry(spark)
    assert df.count() > 0
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in HISTORY.fields]


# Plan nodes no query may use: pair-producing joins, and row-at-a-time or Arrow Python
# evaluation (every expression stays in the JVM).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(spark, key):
    with stage_scope(spark):
        df = E.queries()[key](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [n for n in FORBIDDEN if n in plan], plan
        ok, msg = compare(df, SQL[key], SF_SMALL)
    assert ok, msg


# Scores of learned models beside recomputed ones: compared with each other in test_recompute.py.
VALUES = {"M6_M8_forest_values", "M14_gbt_values", "C6_risk_values"}


def test_every_query_of_this_package_has_an_oracle():
    from sparkrisk.plans import registry

    assert set(registry.queries()) - set(registry.oracle_sql()) == VALUES


SURVEY_IDS = (
    [f"S{i}" for i in range(1, 12)] + [f"P{i}" for i in range(1, 12)] + [f"J{i}" for i in range(1, 6)]
    + [f"A{i}" for i in range(1, 9)] + [f"W{i}" for i in range(1, 6)] + ["O1", "O2", "O3", "U1", "U2"]
    + [f"F{i}" for i in range(1, 13)] + ["D1"] + [f"M{i}" for i in range(1, 17)]
    + [f"T{i}" for i in range(1, 10)] + [f"C{i}" for i in range(1, 8)]
)


def test_every_survey_id_has_a_query():
    keys = list(E.queries())
    missing = [i for i in SURVEY_IDS if not any(k.startswith(i + "_") for k in keys)]
    assert not missing, missing
