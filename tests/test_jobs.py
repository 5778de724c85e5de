"""The job chain end to end: pages -> typed tables -> history -> model -> scored entities."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sparkrisk import fixtures as FX
from sparkrisk.plans import jobs as J
from sparkrisk.session import shared_dir
from sparkrisk.sources import pages as PG


def test_job_chain(spark):
    tag = uuid.uuid4().hex[:8]
    ins_pages, ent_pages = shared_dir(spark, "ins-pages"), shared_dir(spark, "ent-pages")
    PG.write_pages(PG.as_api_records(FX.fx_inspections(spark, SF_SMALL)), ins_pages, 500)
    PG.write_pages(PG.as_api_records(FX.fx_establishments(spark, SF_SMALL)), ent_pages, 500)

    ins = J.extract(spark, ins_pages, f"inspections_{tag}", shared_dir(spark, "ins"), "inspections")
    assert len(ins.columns) == 27 and dict(ins.dtypes)["resultdttm"] == "timestamp_ntz"
    ents = J.extract(spark, ent_pages, f"active_{tag}", shared_dir(spark, "act"), "active")
    assert len(ents.columns) == 14

    hist = J.transform(spark, f"inspections_{tag}", f"inspections_historic_{tag}", shared_dir(spark, "hist"))
    assert len(hist.columns) == 17 and hist.count() > 0

    model_path = shared_dir(spark, "model")
    area = J.train(spark, f"inspections_historic_{tag}", model_path)
    assert 0.0 <= area <= 1.0

    pred = J.predict(spark, f"active_{tag}", f"inspections_historic_{tag}", model_path, f"predict_{tag}",
                     as_of=FX.AS_OF, path=shared_dir(spark, "predict"))
    assert len(pred.columns) == 15 and "proba" in pred.columns
    assert pred.count() == ents.count()
    assert pred.filter(F.col("proba").isNull() | (F.col("proba") < 0) | (F.col("proba") > 1)).count() == 0


def test_jobs_in_processes_of_their_own(spark, tmp_path):
    """Each job only sees what earlier ones wrote to paths: no shared catalog, no shared session."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    ins, ents = str(tmp_path / "ins"), str(tmp_path / "ents")
    from sparkrisk.schemas import ACTIVE_RAW, INSPECTIONS_RAW

    PG.parse_times(PG.conform(FX.fx_inspections(spark, SF_SMALL), INSPECTIONS_RAW), ["resultdttm", "issdttm"]).write.parquet(ins)
    PG.conform(FX.fx_establishments(spark, SF_SMALL), ACTIVE_RAW).write.parquet(ents)

    def job(*args):
        env = os.environ | {"PYTHONPATH": str(root), "PYSPARK_SUBMIT_ARGS": f"--master local[2] --conf spark.ui.enabled=false "
                            f"--conf spark.sql.shuffle.partitions=4 --conf spark.sql.warehouse.dir={tmp_path}/wh pyspark-shell"}
        subprocess.run([sys.executable, "-m", "sparkrisk.plans.jobs", *args], cwd=tmp_path, env=env, check=True, timeout=300,
                       capture_output=True)

    job("transform", "--inspections", ins, "--table", "h", "--path", str(tmp_path / "hist"))
    job("train", "--history", str(tmp_path / "hist"), "--model", str(tmp_path / "model"))
    job("predict", "--entities", ents, "--history", str(tmp_path / "hist"), "--model", str(tmp_path / "model"), "--table", "p",
        "--path", str(tmp_path / "out"), "--as-of", FX.AS_OF)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == spark.read.parquet(ents).count() and out.filter("proba between 0 and 1").count() == out.count()
    assert not (tmp_path / "spark-warehouse").exists()


def test_stages_belong_to_their_scope(spark):
    from sparkrisk.session import materialize, stage_scope

    with stage_scope(spark) as outer:
        a = materialize(spark.range(5))
        with stage_scope(spark) as inner:
            b = materialize(spark.range(7))
            assert b.count() == 7 and len(inner) == 1
        assert len(outer) == 1 and a.count() == 5  # the inner scope took only its own
    c = materialize(spark.range(3))
    assert c.count() == 3
