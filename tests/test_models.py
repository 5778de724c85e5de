"""Properties of splits, evaluation and learned models (no SQL twin for the models)."""

import __spark_entry__ as E
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sparkrisk.ml import evaluate as EV
from sparkrisk.ml import model as MD
from sparkrisk.plans import q_history as QH
from sparkrisk.session import shared_dir


def test_split_disjoint_complete_and_partition_free(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    a_train, a_test = EV.hash_split(df, "k")
    b_train, b_test = EV.hash_split(df.repartition(13), "k")
    ta = {r.k for r in a_train.collect()}
    assert ta == {r.k for r in b_train.collect()}
    assert ta.isdisjoint({r.k for r in a_test.collect()})
    assert a_train.count() + a_test.count() == 5000


def test_split_keeps_null_keys_and_takes_all(spark):
    df = spark.createDataFrame([(str(i) if i % 11 else None, i) for i in range(55)], "k string, i int")
    train, test = EV.hash_split(df, "k")
    assert train.count() + test.count() == 55
    all_, none = EV.hash_split(spark.range(200_000), "id", share=1.0)
    assert all_.count() == 200_000 and none.count() == 0
    half = EV.hash_split(spark.range(200_000), "id", share=0.5)[0].count()
    assert abs(half - 100_000) < 1500


def test_too_many_categories_are_refused(spark):
    import pytest

    df = spark.range(500).selectExpr("CAST(id AS STRING) AS city")
    with pytest.raises(ValueError, match="city"):
        MD.check_categories(df, ["city"], most=100)


def test_roc_and_auc_ties_and_single_class(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.5, 1), (0.1, 0)], "s double, y int")
    # pairs (pos, neg): (0.9, 0.9) tie 0.5, (0.9, 0.1) 1, (0.5, 0.9) 0, (0.5, 0.1) 1
    assert abs(EV.auc(df, "s", "y").first().auc - 0.625) < 1e-12
    roc = [(r.fpr, r.tpr) for r in EV.roc_curve(df, "s", "y").orderBy("fpr", "tpr").collect()]
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    assert all(a[0] <= b[0] and a[1] <= b[1] for a, b in zip(roc, roc[1:]))
    one = spark.createDataFrame([(0.9, 1), (0.2, 1)], "s double, y int")
    assert EV.auc(one, "s", "y").first().auc is None


def test_risk_model_properties(spark):
    hist = QH.history(spark, SF_SMALL)
    model, scored = MD.train_risk(hist)
    area = MD.evaluate_auc(scored)
    assert 0.0 <= area <= 1.0
    feats = QH.features(spark, SF_SMALL)
    risk = MD.predict_risk(feats, model)
    assert risk.count() == feats.count()
    assert risk.filter(F.col("proba").isNull() | (F.col("proba") < 0) | (F.col("proba") > 1)).count() == 0
    assert "probability" not in risk.columns and "proba" in risk.columns
    path = MD.save_model(model, shared_dir(spark, "model"))
    again = MD.predict_risk(feats, MD.load_model(path))
    a = {r._id: r.proba for r in risk.collect()}
    b = {r._id: r.proba for r in again.collect()}
    assert a == b
    _, scored2 = MD.train_risk(hist)
    assert MD.evaluate_auc(scored2) == area
    imp = MD.importances(model, scored).collect()
    assert imp[0].importance == 100.0


def test_roc_trapezoid_equals_auc_on_documents(spark):
    from sparkrisk import fixtures as FX
    from sparkrisk.operators.text import labelled_text

    docs = labelled_text(FX.table(spark, SF_SMALL, "documents"), FX.table(spark, SF_SMALL, "labels"))
    pts = sorted((r.fpr, r.tpr) for r in EV.roc_curve(docs, "n_chars", "quality").collect())
    assert pts[0] == (0.0, 0.0) and pts[-1] == (1.0, 1.0)
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    assert abs(area - EV.auc(docs, "n_chars", "quality").first().auc) < 1e-9


def test_text_models_score_every_text(spark):
    from sparkrisk.ml import text_model as TM

    df = spark.createDataFrame(
        [(i, ("good fine nice " if i % 2 else "bad poor awful ") * 4, float(i % 2)) for i in range(40)],
        "doc_id long, text string, label double",
    )
    for kind in ("ngram", "embed"):
        scored = TM.score_text(TM.fit_text(df, kind=kind), df).collect()
        assert len(scored) == 40 and all(0.0 <= r.proba <= 1.0 for r in scored)


def test_drop_invariant_removes_constant_features(spark):
    from pyspark.ml.functions import vector_to_array

    rows = [(f"c{i % 3}", "same", "x" if i % 2 else "y", "02116", i % 4, i, 0, i % 2, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "licensecat string, descript string, city string, zip string, "
                                     "inspections_so_far int, days_since_last_inspect int, last_viol_fail int, "
                                     "last_viol_pass int, fail int")
    model = MD.risk_pipeline(drop_invariant=True).fit(df)
    out = model.transform(df).select(F.size(vector_to_array("features")).alias("all"),
                                     F.size(vector_to_array("selected")).alias("kept")).first()
    # constant: last_viol_fail, the single descript slot and the single zip slot
    assert out["all"] - out["kept"] == 3


def test_word_vectors_follow_neighbours(spark):
    from sparkrisk.ml import text_model as TM

    texts = [f"the {a} runs {i % 5} home" for i in range(40) for a in ("cat", "dog")]
    texts += [f"price {b} rose {i % 5} percent" for i in range(40) for b in ("oil", "gas")] + ["alone", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = TM.word_vectors(df.repartition(3))
    v = {r.word: [r[f"v{d}"] for d in range(TM.EMBED_DIM)] for r in out.collect()}
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(v[a], v[b]))
    assert dist("cat", "dog") < dist("cat", "oil") and dist("oil", "gas") < dist("dog", "gas")
    assert v["alone"] == [0] * TM.EMBED_DIM
    once = sorted(map(tuple, out.collect()))
    assert once == sorted(map(tuple, TM.word_vectors(df.coalesce(1)).collect()))
    docs = {r.doc_id: r for r in TM.text_vectors(df.union(df), out).collect()}
    assert len(docs) == len(texts) and docs[len(texts) - 1].embedding == [0.0] * TM.EMBED_DIM
    first = docs[0]
    assert first.n_words == 5
    assert first.embedding == [sum(v[w][d] for w in texts[0].split()) / 5 / TM.UNIT for d in range(TM.EMBED_DIM)]
    assert TM.text_vectors(df.limit(0), out).count() == 0


def test_vectors_move_once_a_chunk(spark):
    from sparkrisk.ml import text_model as TM
    from sparkrisk.operators import arrow_text as AT

    texts = ["a b a  c", None, "", "b c", "\t", "x " * 50] * 40
    df = spark.createDataFrame([(None if i == 3 else i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    rows = AT.word_counts(df, "text", ["doc_id"]).collect()
    assert len(rows) == len(texts) and len({r.chunk for r in rows}) == 1
    assert [len(r.words) for r in rows if r.words] == [4]  # all words once, however many texts hold them
    known = TM.word_vectors(df).filter("word <> 'x'")
    v = {r.word: r for r in known.collect()}
    out = {r.doc_id: r for r in TM.text_vectors(df, known).collect()}
    assert len(out) == len(texts) and out[None].n_words == 2 and out[5].n_words == 50 and set(out[5].embedding) == {0.0}
    assert out[0].embedding == [(2 * v["a"][d] + v["b"][d] + v["c"][d]) / 4 / TM.UNIT for d in (f"v{i}" for i in range(TM.EMBED_DIM))]


def test_training_parts_follow_the_rows(spark):
    from sparkrisk.ml import text_model as TM

    assert [TM.training_parts(spark.range(n)) for n in (0, 1, TM.ROWS_PER_PART, TM.ROWS_PER_PART + 1)] == [1, 1, 1, 2]


def test_fits_spread_their_rows_over_tasks(spark):
    rows = spark.range(0, 10_000, 1, 2).selectExpr("id", "id % 7 AS v", "CAST(NULL AS STRING) AS n")
    out = MD.spread(rows, 1_000)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 10_000 and max(sizes) < 1_300
    assert sorted(r.id for r in out.collect()) == list(range(10_000))
    assert MD.spread(rows, 5_000) is rows  # few rows stay where they are
    assert MD.spread(rows.limit(0), 5_000).count() == 0
    assert MD.ROWS_PER_TASK * 452 < 120e6  # bytes of a row that a forest reads


@pytest.mark.parametrize("key", ["M7_fit_pipeline", "C6_risk_values"])
def test_fits_of_queries_take_spread_rows(spark, monkeypatch, key):
    own_spread, own_fit, tasks = MD.spread, MD.fit, []

    def fit(df, *args, **params):
        tasks.extend(r["count"] for r in df.groupBy(F.spark_partition_id().alias("task")).count().collect())
        return own_fit(df, *args, **params)

    monkeypatch.setattr(MD, "spread", lambda df: own_spread(df, 50))
    monkeypatch.setattr(MD, "fit", fit)
    E.queries()[key](spark, SF_SMALL)
    assert sum(tasks) > 1_000 and max(tasks) < 80


def test_grid_search_encodes_once_a_fold(spark, monkeypatch):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    rows = [(f"c{i % 3}", f"d{i % 5}", "x" if i % 2 else None, "02116", i % 4, i, i % 7, 0, int(i * i % 11 < 5)) for i in range(400)]
    df = spark.createDataFrame(rows, "licensecat string, descript string, city string, zip string, "
                                     "inspections_so_far int, days_since_last_inspect int, last_viol_fail int, "
                                     "last_viol_pass int, fail int").repartition(3, "days_since_last_inspect")
    own, calls = StringIndexer.fit, []
    monkeypatch.setattr(StringIndexer, "fit", lambda self, *a: calls.append(1) or own(self, *a))
    model, table = MD.grid_search(df, folds=2, grid={"maxDepth": [1, 3]}, maxIter=3)
    assert len(calls) == 3  # once a fold and once for the refit, however many settings the grid has
    # MLlib's search over the whole chain gives the same areas and the same best model.
    pipe = MD.risk_pipeline("gbt", maxIter=3)
    maps = ParamGridBuilder().addGrid(pipe.getStages()[-1].maxDepth, [1, 3]).build()
    folded = df.withColumn("__fold", (F.abs(F.xxhash64(*df.columns, F.lit(7))) % 2).cast("int"))
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, foldCol="__fold", numFolds=2, seed=7,
                        evaluator=BinaryClassificationEvaluator(labelCol=MD.LABEL, numBins=0)).fit(folded)
    assert max(abs(r.auc - a) for r, a in zip(table.collect(), cv.avgMetrics)) < 1e-9
    assert model.stages[-1].toDebugString.split("\n")[1:] == cv.bestModel.stages[-1].toDebugString.split("\n")[1:]
    assert [type(s) for s in model.stages] == [type(s) for s in cv.bestModel.stages]


def test_fits_side_by_side_follow_their_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert [MD.fits_at_once(spark.range(0, 100, 1, n), 4) for n in (1, 2 * cores, 3 * cores, 9 * cores)] == [min(4, 3 * cores), 2, 1, 1]


def test_a_fit_keeps_only_what_it_reads(spark, monkeypatch):
    rows = [("k" * 50, "a", f"d{i % 3}", "c", "z", i, i % 7, 0, 1, i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, ["__key", *MD.CATEGORICAL_FEATURES, *MD.NUMERIC_FEATURES, MD.LABEL])
    kept = []
    monkeypatch.setattr(MD, "fit", lambda train, **params: kept.append((train.columns, train.is_cached, train.count())))
    MD.fit_kept(df)
    assert kept == [([*MD.CATEGORICAL_FEATURES, *MD.NUMERIC_FEATURES, MD.LABEL], True, 40)]
