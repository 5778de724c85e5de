"""Checked queries for splits, encoders, models and evaluation.

A learned value has no SQL twin. Queries of learned models therefore return the key of every row
with facts about the value (a score equal to the one computed anew from the model's saved nodes, a
prediction that is the likelier class, equal scores of a loaded model, a risk above chance), and
their oracles say which rows there are and that every fact is true. The ``*_values`` queries return
the scores themselves beside the recomputed ones; they have no oracle. Splits, indexes, one-hot slots, assembled vectors, ROC, AUC and accuracy of a
rule are compared by value.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkrisk import fixtures as FX
from sparkrisk.ml import evaluate as EV
from sparkrisk.ml import model as MD
from sparkrisk.ml import recompute as RC
from sparkrisk.functions.scalar import WHITESPACE
from sparkrisk.ml import text_model as TM
from sparkrisk.operators import text as TX
from sparkrisk.plans import q_history as QH
from sparkrisk.plans.registry import query
from sparkrisk.plans.sql import CTE_FEATURES, CTE_HISTORY
from sparkrisk.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from sparkrisk.session import shared_dir

CATS = list(CATEGORICAL_FEATURES)


def _training(spark, sf_dir):
    return MD.training_frame(QH.history(spark, sf_dir))


def _encoding_model(spark, sf_dir):
    return Pipeline(stages=[*MD.indexers(), *MD.encoders(), MD.assembler()]).fit(_training(spark, sf_dir))


# SQL: training rows as the model sees them, and per-column index tables.
CTE_TRAIN = CTE_FEATURES + """,
train AS (SELECT licensecat, descript, city, coalesce(zip, '02116') AS zip FROM hist)"""


def _cte_index(c):
    return (f"idx_{c} AS (SELECT value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS INTEGER) AS idx "
            f"FROM (SELECT {c} AS value, count(*) AS n FROM train WHERE {c} IS NOT NULL GROUP BY {c}))")


CTE_INDEXES = CTE_TRAIN + ",\n" + ",\n".join(_cte_index(c) for c in CATS)


@query(
    "M1_hash_split",
    "SELECT o_orderkey, substr(md5(CAST(o_orderkey AS VARCHAR) || '1407'), 1, 8) < 'e6666666' AS is_train FROM orders",
)
def m1_hash_split(spark, sf_dir):
    orders = FX.table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", EV.split_column("o_orderkey", EV.TRAIN_SHARE, EV.SPLIT_SEED).alias("is_train"))


@query(
    "M2_string_index",
    f"WITH {CTE_INDEXES} SELECT value, CAST(idx AS DOUBLE) AS index FROM idx_city",
)
def m2_string_index(spark, sf_dir):
    return MD.string_index(_training(spark, sf_dir), "city")


@query(
    "M2_string_indexer_model",
    f"WITH {CTE_INDEXES} SELECT value, CAST(idx AS DOUBLE) AS index FROM idx_city",
)
def m2_string_indexer_model(spark, sf_dir):
    """The fitted MLlib indexer's labels, as (value, index)."""
    model = MD.indexers(["city"])[0].fit(_training(spark, sf_dir))  # labelsArray[0]: the city labels
    rows = [(v, float(i)) for i, v in enumerate(model.labelsArray[0])]
    return spark.createDataFrame(rows, "value string, index double")


@query(
    "M3_one_hot",
    f"WITH {CTE_INDEXES} "
    + " UNION ALL ".join(
        f"SELECT f._id, '{c}' AS feature, ix.idx AS slot, CAST(1.0 AS DOUBLE) AS value FROM feat f JOIN idx_{c} ix ON f.{c} = ix.value"
        for c in CATS
    ),
)
def m3_one_hot(spark, sf_dir):
    scored = _encoding_model(spark, sf_dir).transform(QH.features(spark, sf_dir))
    parts = [MD.slots_long(scored, "_id", f"{c}Vec").withColumn("feature", F.lit(c)) for c in CATS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("_id", "feature", "slot", "value")


def _assemble_body():
    sizes = {c: f"(SELECT count(*) FROM idx_{c})" for c in CATS}
    offs, acc = {}, "4"
    for c in CATS:
        offs[c] = acc
        acc = f"{acc} + {sizes[c]}"
    num = " UNION ALL ".join(
        f"SELECT _id, {i} AS slot, CAST({c} AS DOUBLE) AS value FROM feat WHERE {c} <> 0"
        for i, c in enumerate(NUMERIC_FEATURES)
    )
    cat = " UNION ALL ".join(
        f"SELECT f._id, CAST({offs[c]} + ix.idx AS INTEGER) AS slot, 1.0 AS value FROM feat f "
        f"JOIN idx_{c} ix ON f.{c} = ix.value"
        for c in CATS
    )
    return f"{num} UNION ALL {cat}"


@query("M5_assemble", f"WITH {CTE_INDEXES} {_assemble_body()}")
def m5_assemble(spark, sf_dir):
    scored = _encoding_model(spark, sf_dir).transform(QH.features(spark, sf_dir))
    return MD.slots_long(scored, "_id", "features")


def _labelled_docs(spark, sf_dir):
    return TX.labelled_text(FX.table(spark, sf_dir, "documents"), FX.table(spark, sf_dir, "labels"))


_AUC_SQL = """WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, l.quality AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM s)
SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0)
       / (count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0)) AS auc FROM r"""


@query("M9_auc", _AUC_SQL)
def m9_auc(spark, sf_dir):
    return EV.auc(_labelled_docs(spark, sf_dir), "n_chars", "quality")


@query(
    "M10_roc_curve",
    """WITH s AS (SELECT CAST(d.n_chars AS DOUBLE) AS score, CAST(l.quality AS DOUBLE) AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL SELECT score, fp / n, tp / p FROM c""",
)
def m10_roc_curve(spark, sf_dir):
    return EV.roc_curve(_labelled_docs(spark, sf_dir), "n_chars", "quality")


HELD_OUT_KEY_SQL = "concat_ws('|', property_id, CAST(resultdttm AS VARCHAR))"
HELD_OUT_SQL = f"NOT (substr(md5({HELD_OUT_KEY_SQL} || '1407'), 1, 8) < 'e6666666')"
_RULE = "CASE WHEN last_viol_fail > 0 AND last_viol_fail <> 99999999 THEN 1 ELSE 0 END"


@query(
    "M11_accuracy",
    f"WITH {CTE_HISTORY} SELECT avg(CAST(({_RULE}) = fail AS DOUBLE)) AS accuracy FROM hist "
    f"WHERE {HELD_OUT_SQL}",
)
def m11_accuracy(spark, sf_dir):
    """Accuracy of the rule 'failed last time' on the held-out side of the split."""
    h = QH.history(spark, sf_dir).withColumn("__key", F.concat_ws("|", "property_id", F.col("resultdttm").cast("string")))
    _, test = EV.hash_split(h, "__key")
    pred = F.when((F.col("last_viol_fail") > 0) & (F.col("last_viol_fail") != 99999999), 1).otherwise(0)
    return EV.accuracy(test.withColumn("pred", pred), "pred", "fail")


CTE_INDEXES_WITH = f"WITH {CTE_INDEXES}"


# --- learned models: keys and facts ------------------------------------------------------

def _trained(spark, sf_dir, kind="forest", hist=None):
    return MD.train_risk(QH.history(spark, sf_dir) if hist is None else hist, kind=kind)


def _in_range(col="proba"):
    return (F.col(col) >= 0) & (F.col(col) <= 1)


def _held_out_sql(facts):
    return f"WITH {CTE_HISTORY} SELECT {HELD_OUT_KEY_SQL} AS key, {facts} FROM hist WHERE {HELD_OUT_SQL}"


def _entities_sql(facts):
    return f"WITH {CTE_FEATURES} SELECT _id, {facts} FROM feat"


def _better_than_chance(area):
    """Area under ROC as a fact: the held-out rows are ranked better than at random."""
    return F.lit(0.5 < area <= 1.0)


def _agrees(score="probability", column="recomputed"):
    """The score is the one that the saved nodes give."""
    p = vector_to_array(score)[1] if score == "probability" else F.col(score)
    return F.coalesce(F.abs(p - F.col(column)) < 1e-9, F.lit(False))


@query("C4_train_risk", _held_out_sql("true AS proba_ok, true AS recomputed_ok, true AS auc_ok"))
def c4_train_risk(spark, sf_dir):
    """Held-out rows with their risk; the held-out AUC is above chance."""
    model, scored = _trained(spark, sf_dir)
    area = MD.evaluate_auc(scored)
    checked = RC.recomputed_score(scored, model).withColumn("recomputed_ok", _agrees())
    return MD.with_risk(checked).select(F.col("__key").alias("key"), _in_range().alias("proba_ok"), "recomputed_ok",
                                        _better_than_chance(area).alias("auc_ok"))


@query("C6_predict_risk", _entities_sql("businessname, city, true AS proba_ok").replace("businessname,", "BusinessName AS businessname,"))
def c6_predict_risk(spark, sf_dir):
    """Train on the history and score the entities with the same history (built once)."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    risk = MD.predict_risk(QH.features(spark, sf_dir, hist), model)
    return risk.select("_id", F.col("BusinessName").alias("businessname"), "city", _in_range().alias("proba_ok"))


@query(
    "C7_review_scores",
    f"WITH {CTE_FEATURES} SELECT CAST(r AS INTEGER) AS position, true AS sorted_ok, true AS entity_ok "
    "FROM (SELECT unnest(range(1, 1 + least(30, (SELECT count(*) FROM feat)))) AS r)",
)
def c7_review_scores(spark, sf_dir):
    """The 30 entities of highest risk, by SQL over a temp view: positions, falling risk, and each
    one an entity of the scored table."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    MD.predict_risk(QH.features(spark, sf_dir, hist), model).createOrReplaceTempView("predict")
    top = spark.sql(
        "SELECT BusinessName AS businessname, descript, city, proba, property_id FROM predict "
        "ORDER BY proba DESC, property_id LIMIT 30"
    )
    w = Window.orderBy(F.col("proba").desc(), "property_id")  # at most 30 rows
    ranked = top.select("*", F.row_number().over(w).alias("position"), F.lag("proba").over(w).alias("before"))
    known = FX.fx_establishments(spark, sf_dir).select(F.col("Property_ID").alias("property_id"), F.lit(True).alias("known"))
    return ranked.join(known, "property_id", "left").select(
        "position", F.coalesce(F.col("before") >= F.col("proba"), F.lit(True)).alias("sorted_ok"),
        F.coalesce("known", F.lit(False)).alias("entity_ok"))


def _kept_slots_sql():
    """Slots of the assembled vector that vary in the training rows, numbered anew."""
    sizes = {c: f"(SELECT count(*) FROM idx_{c})" for c in CATS}
    parts = [f"SELECT {i} AS slot, var_pop({c}) > 0 AS varies FROM hist" for i, c in enumerate(NUMERIC_FEATURES)]
    off = "4"
    for c in CATS:
        parts.append(f"SELECT CAST({off} + idx AS INTEGER) AS slot, "
                     f"(SELECT count(*) FROM train WHERE {c} = value) < (SELECT count(*) FROM train) AS varies FROM idx_{c}")
        off = f"{off} + {sizes[c]}"
    kept = f"kept AS (SELECT slot, CAST(row_number() OVER (ORDER BY slot) - 1 AS INTEGER) AS new_slot FROM ({' UNION ALL '.join(parts)}) WHERE varies)"
    # The assembled long form, then only the kept slots.
    return f"{CTE_INDEXES_WITH},\n{kept},\nlong AS ({_assemble_body()}) SELECT _id, new_slot AS slot, value FROM long JOIN kept USING (slot)"


@query("M4_drop_invariant", _kept_slots_sql())
def m4_drop_invariant(spark, sf_dir):
    """Encoded entity rows without the columns that are constant in the training rows."""
    hist = QH.history(spark, sf_dir)  # built once
    train = MD.spread(MD.training_frame(hist)).fillna(0, subset=list(NUMERIC_FEATURES))
    model = MD.risk_pipeline(drop_invariant=True).fit(train)
    return MD.slots_long(model.transform(QH.features(spark, sf_dir, hist)), "_id", "selected")


def _class_facts(probability="probability"):
    p = vector_to_array(probability)
    return [(F.abs(p[0] + p[1] - 1) < 1e-9).alias("sums_to_one"),
            F.when(p[0] == p[1], True).otherwise(F.col("prediction") == (p[1] > p[0]).cast("double")).alias("likelier_class")]


@query("M6_M8_forest_scores", _held_out_sql("true AS sums_to_one, true AS likelier_class, true AS recomputed_ok"))
def m6_m8_forest_scores(spark, sf_dir):
    """Held-out rows scored by the forest, against its saved nodes."""
    model, scored = _trained(spark, sf_dir)
    checked = RC.recomputed_score(scored, model)
    return checked.select(F.col("__key").alias("key"), *_class_facts(), _agrees().alias("recomputed_ok"))


def _values(scored, key):
    return scored.select(key, vector_to_array("probability")[1].alias("proba"), "recomputed")


@query("M6_M8_forest_values")
def m6_m8_forest_values(spark, sf_dir):
    """P(fail) of the held-out rows, and the same from the forest's saved nodes."""
    model, scored = _trained(spark, sf_dir)
    return _values(RC.recomputed_score(scored, model), F.col("__key").alias("key"))


@query("M14_gbt_values")
def m14_gbt_values(spark, sf_dir):
    """P(fail) of the held-out rows, and the same from the boosted trees' saved nodes."""
    model, scored = _trained(spark, sf_dir, kind="gbt")
    return _values(RC.recomputed_score(scored, model, kind="gbt"), F.col("__key").alias("key"))


@query("C6_risk_values")
def c6_risk_values(spark, sf_dir):
    """The risk of every entity, and the same from the forest's saved nodes."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    return _values(RC.recomputed_score(MD.score(model, QH.features(spark, sf_dir, hist)), model), "_id")


@query("M12_save_load", _entities_sql("true AS same_score"))
def m12_save_load(spark, sf_dir):
    """Scores of a model that was saved and loaded again, against those of the model itself."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    path = MD.save_model(model, shared_dir(spark, "predict_ranking"))
    feats = QH.features(spark, sf_dir, hist)
    own = MD.predict_risk(feats, model).select("_id", F.col("proba").alias("own"))
    loaded = MD.predict_risk(feats, MD.load_model(path)).select("_id", "proba")
    return loaded.join(own, "_id", "left").select("_id", F.col("proba").eqNullSafe(F.col("own")).alias("same_score"))


@query(
    "M13_grid_search",
    f"WITH {CTE_HISTORY} SELECT params, true AS auc_ok, (SELECT count(*) FROM hist) AS rows FROM (VALUES "
    "('maxDepth=3, stepSize=0.1'), ('maxDepth=3, stepSize=0.3'), ('maxDepth=6, stepSize=0.1'), ('maxDepth=6, stepSize=0.3')) t(params)",
)
def m13_grid_search(spark, sf_dir):
    """Every combination of the grid with its mean AUC above chance, over all training rows."""
    train = _training(spark, sf_dir).fillna(0, subset=list(NUMERIC_FEATURES))
    _, table = MD.grid_search(train, folds=5, seed=7, kind="gbt")
    ok = (F.col("auc") > 0.5) & (F.col("auc") <= 1)
    return table.select("params", ok.alias("auc_ok"), F.lit(train.count()).cast("bigint").alias("rows"))


@query("M14_gbt_scores", _held_out_sql("true AS proba_ok, true AS recomputed_ok, true AS auc_ok"))
def m14_gbt_scores(spark, sf_dir):
    """Held-out rows scored by boosted trees, against their saved nodes."""
    model, scored = _trained(spark, sf_dir, kind="gbt")
    area = MD.evaluate_auc(scored)
    checked = RC.recomputed_score(scored, model, kind="gbt").withColumn("recomputed_ok", _agrees())
    return MD.with_risk(checked).select(F.col("__key").alias("key"), _in_range().alias("proba_ok"), "recomputed_ok",
                                        _better_than_chance(area).alias("auc_ok"))


@query("M15_with_risk", _held_out_sql("property_id, fail, true AS proba_ok, true AS float_ok"))
def m15_with_risk(spark, sf_dir):
    """Held-out rows without the working columns: what is left, and the risk as a float."""
    _, scored = _trained(spark, sf_dir)
    risk = MD.with_risk(scored)
    kept = not set(MD.WORK_COLUMNS) & set(risk.columns)
    return risk.select(F.col("__key").alias("key"), "property_id", "fail", (_in_range() & F.lit(kept)).alias("proba_ok"),
                       F.lit(dict(risk.dtypes)["proba"] == "float").alias("float_ok"))


def _feature_names_sql():
    cats = " UNION ALL ".join(f"SELECT '{c}Vec_' || value AS feature FROM idx_{c}" for c in CATS)
    nums = " UNION ALL ".join(f"SELECT '{c}' AS feature" for c in NUMERIC_FEATURES)
    return f"{CTE_INDEXES_WITH}, names AS ({nums} UNION ALL {cats})"


@query("M16_importances", _feature_names_sql() + " SELECT feature, true AS in_range, true AS scaled FROM names")
def m16_importances(spark, sf_dir):
    """Every feature by name, with a share of the largest importance, which is 100."""
    model, scored = _trained(spark, sf_dir)
    imp = MD.importances(model, scored)
    top = imp.agg(F.max("importance").alias("top")).scalar()
    return imp.select("feature", F.col("importance").between(0, 100).alias("in_range"), (top == 100.0).alias("scaled"))


@query("T7_embed", f"SELECT doc_id, {TM.EMBED_DIM} AS size, true AS finite FROM documents")
def t7_embed(spark, sf_dir):
    """Vectors of every text, learned from every text."""
    docs = FX.table(spark, sf_dir, "documents").select("doc_id", "text")
    v = vector_to_array("embedding")
    finite = F.forall(v, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return TM.embed_pipeline(parts=TM.training_parts(docs)).fit(docs).transform(docs).select("doc_id", F.size(v).alias("size"), finite.alias("finite"))


def _text_vectors_sql():
    dims, k = range(TM.EMBED_DIM), TM.NEIGHBOURS
    bits = ", ".join(f"sum((c.h >> {d}) & 1) AS b{d}" for d in dims)
    values = ", ".join(f"coalesce(CAST(floor((n - 2 * b{d}) * CAST({TM.UNIT} AS DOUBLE) / n) AS BIGINT), 0) AS v{d}" for d in dims)
    sums = ", ".join(f"sum(v{d}) AS s{d}" for d in dims)
    means = ", ".join(f"coalesce(CAST(s{d} AS DOUBLE) / known / CAST({TM.UNIT} AS DOUBLE), 0.0)" for d in dims)
    return (
        "WITH w AS MATERIALIZED (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, "
        f"list_filter(regexp_split_to_array(coalesce(text, ''), '{WHITESPACE}'), lambda x: x <> '') AS ws FROM documents)), "
        "c AS MATERIALIZED (SELECT *, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) AS h FROM w), "
        f"sums AS (SELECT a.word, count(*) AS n, {bits} FROM w a JOIN c ON a.doc_id = c.doc_id "
        f"AND c.i IN ({', '.join(f'a.i + {j}' for j in range(-k, k + 1) if j)}) GROUP BY a.word), "
        f"vec AS (SELECT word, {values} FROM sums), "
        f"total AS (SELECT d.doc_id, count(w.word) AS n_words, count(w.word) AS known, {sums} FROM documents d "
        "LEFT JOIN w ON d.doc_id = w.doc_id LEFT JOIN vec ON w.word = vec.word GROUP BY d.doc_id) "
        f"SELECT doc_id, n_words, [{means}] AS embedding FROM total"
    )


@query("T7_text_vectors", _text_vectors_sql())
def t7_text_vectors(spark, sf_dir):
    """Vectors of every word, learned from every text, and their mean for every text, by value."""
    docs = FX.table(spark, sf_dir, "documents").select("doc_id", "text")
    return TM.text_vectors(docs, TM.word_vectors(docs))


@query("T9_text_model", "SELECT doc_id, true AS proba_ok FROM documents")
def t9_text_model(spark, sf_dir):
    """Raw text to probability for every text, by a model of the labelled training side."""
    labelled = _labelled_docs(spark, sf_dir).select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    train, _ = EV.hash_split(labelled, "doc_id")
    model = TM.fit_text(train)
    every = FX.table(spark, sf_dir, "documents").select("doc_id", "text")
    return TM.score_text(model, every).select("doc_id", _in_range().alias("proba_ok"))


@query(
    "M7_fit_pipeline",
    f"{CTE_INDEXES_WITH} SELECT * FROM (VALUES (0, 'StringIndexerModel', "
    "'licensecatIndex,descriptIndex,cityIndex,zipIndex', (SELECT count(*) FROM idx_licensecat) + (SELECT count(*) FROM idx_descript) "
    "+ (SELECT count(*) FROM idx_city) + (SELECT count(*) FROM idx_zip)), "
    "(1, 'OneHotEncoderModel', 'licensecatVec,descriptVec,cityVec,zipVec', 0), (2, 'VectorAssembler', 'features', 0), "
    "(3, 'RandomForestClassificationModel', 'prediction', 0)) t(stage, kind, output, labels)",
)
def m7_fit_pipeline(spark, sf_dir):
    """The fitted chain: (stage, kind, output, number of indexed values) per stage, in order. The
    chain is fitted on the training side; its indexes are compared on all of the history."""
    model = MD.fit_kept(_training(spark, sf_dir))
    rows = []
    for i, st in enumerate(model.stages):
        if st.hasParam("outputCols") and st.isSet("outputCols"):
            out = ",".join(st.getOrDefault("outputCols"))
        elif st.hasParam("outputCol"):
            out = st.getOrDefault("outputCol")
        else:
            out = st.getOrDefault("predictionCol")
        labels = sum(len(x) for x in st.labelsArray) if type(st).__name__ == "StringIndexerModel" else 0
        rows.append((i, type(st).__name__, out, labels))
    return spark.createDataFrame(rows, "stage int, kind string, output string, labels long")


@query("M8_score", _entities_sql("true AS sums_to_one, true AS likelier_class, true AS recomputed_ok"))
def m8_score(spark, sf_dir):
    """Entity rows scored by the fitted chain."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    checked = RC.recomputed_score(MD.score(model, QH.features(spark, sf_dir, hist)), model)
    return checked.select("_id", *_class_facts(), _agrees().alias("recomputed_ok"))


@query("F12_vector_element", _held_out_sql("true AS same_value"))
def f12_vector_element(spark, sf_dir):
    """P(fail) read from the probability vector with a built-in function, against the value that the
    model's saved nodes give."""
    model, scored = _trained(spark, sf_dir)
    checked = RC.recomputed_score(scored, model)
    same = F.abs(MD.vector_element("probability", 1) - F.col("recomputed")) < 1e-6  # the element is a float
    return checked.select(F.col("__key").alias("key"), same.alias("same_value"))


@query("D1_proba_without_udf", _entities_sql("true AS same_value"))
def d1_proba_without_udf(spark, sf_dir):
    """The reference's one Python UDF (vector to float of element 1), replaced by
    ``vector_to_array`` so scoring never leaves the JVM."""
    hist = QH.history(spark, sf_dir)
    model, _ = _trained(spark, sf_dir, hist=hist)
    scored = MD.score(model, QH.features(spark, sf_dir, hist))
    own = vector_to_array("probability")[1].cast("float")
    return MD.with_risk(scored.withColumn("own", own)).select("_id", (F.col("proba") == F.col("own")).alias("same_value"))


@query(
    "O3_importances_sorted",
    _feature_names_sql() + " SELECT CAST(r AS INTEGER) AS position, true AS sorted_ok FROM "
    "(SELECT unnest(range(1, 1 + (SELECT count(*) FROM names))) AS r)",
)
def o3_importances_sorted(spark, sf_dir):
    """Importances in falling order: position by position, none above the one before."""
    model, scored = _trained(spark, sf_dir)
    w = Window.orderBy(F.col("importance").desc(), "feature")  # one row per feature slot
    imp = MD.importances(model, scored).withColumn("before", F.lag("importance").over(w))
    return imp.select(F.row_number().over(w).alias("position"), F.coalesce(F.col("before") >= F.col("importance"), F.lit(True)).alias("sorted_ok"))


@query(
    "M11_accuracy_model",
    f"WITH {CTE_HISTORY} SELECT count(*) AS rows, true AS in_range, true AS beats_rule FROM hist WHERE {HELD_OUT_SQL}",
)
def m11_accuracy_model(spark, sf_dir):
    """Accuracy of the fitted forest on the held-out side: at least that of the better constant
    answer, less one hundredth."""
    _, scored = _trained(spark, sf_dir)
    acc = EV.accuracy(scored, "prediction", MD.LABEL)
    share = scored.agg(F.count(F.lit(1)).alias("rows"), F.avg(F.col(MD.LABEL).cast("double")).alias("fail"))
    share = share.withColumn("accuracy", acc.scalar())
    return share.select("rows", F.col("accuracy").between(0, 1).alias("in_range"),
                        (F.col("accuracy") >= F.greatest(F.col("fail"), 1 - F.col("fail")) - 0.01).alias("beats_rule"))
