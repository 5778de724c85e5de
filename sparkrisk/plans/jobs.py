"""The batch jobs, chained through paths: extract -> transform -> train -> predict.

    python -m sparkrisk.plans.jobs extract   --pages P --table T --path OUT [--layout inspections|active]
    python -m sparkrisk.plans.jobs transform --inspections PATH --table T --path OUT
    python -m sparkrisk.plans.jobs train     --history PATH --model OUT
    python -m sparkrisk.plans.jobs predict   --entities PATH --history PATH --model M --table T --path OUT [--as-of D]

Each job is a process of its own: it reads what earlier ones wrote by its path (or by its
catalog name, where the session has a shared catalog), runs on Spark, and writes a table at
``--path``; file sizes are left to adaptive execution.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sparkrisk.ml import model as MD
from sparkrisk.operators import history as H
from sparkrisk.schemas import ACTIVE_RAW, ACTIVE_TIME_COLUMNS, INSPECTION_TIME_COLUMNS, INSPECTIONS_RAW
from sparkrisk.session import prepare, stage_scope
from sparkrisk.sources import pages as PG
from sparkrisk.sources import tables as TB

LAYOUTS = {
    "inspections": (INSPECTIONS_RAW, INSPECTION_TIME_COLUMNS),
    "active": (ACTIVE_RAW, ACTIVE_TIME_COLUMNS),
}


def _read(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or parquet at a path."""
    if "/" in name_or_path or ":" in name_or_path:
        return TB.read_table(spark, name_or_path)
    return TB.scan_table(spark, name_or_path)


def extract(spark: SparkSession, pages: str, table: str, path: str, layout: str = "inspections",
            multiline: bool = False) -> DataFrame:
    """Landed page files to a typed table in the given record layout."""
    schema, times = LAYOUTS[layout]
    return PG.ingest(prepare(spark), pages, schema, list(times), table, path, multiline=multiline)


def transform(spark: SparkSession, inspections: str, table: str, path: str) -> DataFrame:
    """C3 + S8: the history table."""
    with stage_scope(prepare(spark)):  # the window stage goes once the table is written
        TB.write_table(H.build_history(_read(spark, inspections)), table, path)
    return spark.table(table)


def train(spark: SparkSession, history: str, model_path: str, kind: str = "forest") -> float:
    """C4 + M12: fit on the hash-split training side, save the model, return the held-out AUC."""
    model, scored = MD.train_risk(_read(prepare(spark), history), kind=kind)
    MD.save_model(model, model_path)
    return MD.evaluate_auc(scored)


def predict(spark: SparkSession, entities: str, history: str, model_path: str, table: str,
            as_of: str | None = None, path: str | None = None) -> DataFrame:
    """C5 + C6 + S8/S9: entity features as of a date, scored, saved at ``path`` (or as a managed
    table of the session's warehouse)."""
    spark = prepare(spark)
    feats = H.latest_features(_read(spark, history), _read(spark, entities), as_of=as_of)
    TB.write_table(MD.predict_risk(feats, MD.load_model(model_path)), table, path)
    return spark.table(table)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="sparkrisk.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    e = sub.add_parser("extract")
    e.add_argument("--pages", required=True)
    e.add_argument("--table", required=True)
    e.add_argument("--path", required=True)
    e.add_argument("--layout", choices=sorted(LAYOUTS), default="inspections")
    e.add_argument("--multiline", action="store_true")
    t = sub.add_parser("transform")
    t.add_argument("--inspections", required=True)
    t.add_argument("--table", required=True)
    t.add_argument("--path", required=True)
    r = sub.add_parser("train")
    r.add_argument("--history", required=True)
    r.add_argument("--model", required=True)
    p = sub.add_parser("predict")
    p.add_argument("--entities", required=True)
    p.add_argument("--history", required=True)
    p.add_argument("--model", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--path", required=True)
    p.add_argument("--as-of", default=None)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"sparkrisk-{a.job}").getOrCreate()
    if a.job == "extract":
        extract(spark, a.pages, a.table, a.path, a.layout, a.multiline)
    elif a.job == "transform":
        transform(spark, a.inspections, a.table, a.path)
    elif a.job == "train":
        print(f"held-out AUC {train(spark, a.history, a.model):.6f}")
    else:
        predict(spark, a.entities, a.history, a.model, a.table, a.as_of, a.path)


if __name__ == "__main__":
    main()
