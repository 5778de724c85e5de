"""Encoders, the risk pipeline, scoring and importances.

Fitting is MLlib's: indexers count labels with one aggregation, the forest aggregates
split statistics per tree level on the executors. Category sets must be bounded (they
become the width of the one-hot vectors and are kept in the model).
"""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrisk.functions.scalar import vector_element  # noqa: F401  (re-exported for queries)
from sparkrisk.ml.evaluate import SPLIT_SEED, TRAIN_SHARE, hash_split
from sparkrisk.operators.sequence import ordered_window
from sparkrisk.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

# Forest settings of the risk model.
FOREST = {"numTrees": 20, "maxDepth": 5, "impurity": "gini", "maxBins": 32}
LABEL = "fail"
# What a fit reads: keys and other columns of a row would fill the memory that its rows need.
MODEL_COLUMNS = (*CATEGORICAL_FEATURES, *NUMERIC_FEATURES, LABEL)
# Working columns removed from scored rows.
WORK_COLUMNS = (*NUMERIC_FEATURES, *(f"{c}{kind}" for c in CATEGORICAL_FEATURES for kind in ("Index", "Vec")),
                "features", "rawPrediction", "prediction", "probability")
# Most rows of one task of a fit. MLlib caches some 450 (forest) to 1,000 bytes (boosted trees) of each.
ROWS_PER_TASK = 250_000
# Most values of a categorical feature: they are kept on the driver and widen every vector.
MAX_CATEGORIES = 100_000


def string_index(df: DataFrame, col: str) -> DataFrame:
    """M2 in SQL terms: (value, index) by frequency descending, ties by value, from 0.
    Unseen and null values take index = number of values (the extra bucket)."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).count()
    # A global numbering is one ordered group: range-partitioned, never one task.
    keyed = counts.withColumns({"__k": F.lit(0), "__neg": -F.col("count")})
    ranked = ordered_window(keyed, "__k", "__neg", ["value"], row_number="__rn")
    return ranked.select("value", (F.col("__rn") - 1).cast("double").alias("index"))


def indexers(cols: Sequence[str] = CATEGORICAL_FEATURES, handle_invalid: str = "keep") -> list:
    """M2: one MLlib indexer for all categorical columns (one counting pass), frequency
    descending, ties alphabetical; 'keep' adds a bucket for unseen and null values."""
    return [StringIndexer(inputCols=list(cols), outputCols=[f"{c}Index" for c in cols],
                          handleInvalid=handle_invalid, stringOrderType="frequencyDesc")]


def encoders(cols: Sequence[str] = CATEGORICAL_FEATURES) -> list:
    """M3: one-hot with the last slot dropped. After an indexer with 'keep', the last
    category is the unseen/null bucket, so n seen values give n slots and an unseen or null
    value gives an all-zero vector."""
    return [OneHotEncoder(inputCols=[f"{c}Index" for c in cols], outputCols=[f"{c}Vec" for c in cols],
                          dropLast=True, handleInvalid="error")]


def assembler(numeric: Sequence[str] = NUMERIC_FEATURES, cats: Sequence[str] = CATEGORICAL_FEATURES) -> VectorAssembler:
    """M5: numeric columns then the one-hot vectors."""
    return VectorAssembler(inputCols=[*numeric, *[f"{c}Vec" for c in cats]], outputCol="features",
                           handleInvalid="keep")


def risk_model(kind: str = "forest", seed: int = SPLIT_SEED, **params):
    """The learner: random forest (default) or boosted trees."""
    if kind == "forest":
        return RandomForestClassifier(labelCol=LABEL, featuresCol="features", seed=seed, **{**FOREST, **params})
    if kind == "gbt":
        return GBTClassifier(labelCol=LABEL, featuresCol="features", seed=seed, **params)
    raise ValueError(f"unknown learner {kind!r}")


def risk_pipeline(kind: str = "forest", drop_invariant: bool = False, **params) -> Pipeline:
    """M7: indexer and encoder (each one multi-column stage, one pass for all categorical
    columns), assembler, learner. With ``drop_invariant`` (M4) constant features are
    removed before the learner."""
    stages = [*indexers(), *encoders(), assembler()]
    learner = risk_model(kind, **params)
    if drop_invariant:
        stages.append(VarianceThresholdSelector(featuresCol="features", outputCol="selected", varianceThreshold=0.0))
        learner.setFeaturesCol("selected")
    stages.append(learner)
    return Pipeline(stages=stages)


def training_frame(history: DataFrame) -> DataFrame:
    """Model input from the history: int features and label, zip default, leaking and
    identifying columns dropped."""
    df = history.withColumns({c: F.col(c).try_cast("int") for c in (*NUMERIC_FEATURES, LABEL)})
    df = df.withColumn("zip", F.coalesce(F.col("zip"), F.lit("02116")))
    return df.drop("location", "last_inspections", "resultdttm", "issdttm", "state", "viol_fail", "viol_pass")


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in tasks of about ``rows_per_task`` rows at most. A scan is cut by compressed bytes, of which a
    history row has few: its tasks would grow with the input. Rows that are spread well enough stay where they are."""
    sizes = df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    if (sizes["most"] or 0) <= rows_per_task:
        return df
    return df.repartition(-(-sizes["rows"] // rows_per_task) + 1, *df.columns)


def check_categories(df: DataFrame, cols: Sequence[str] = CATEGORICAL_FEATURES, most: int = MAX_CATEGORIES) -> None:
    """Refuse features with more than ``most`` values before an indexer collects them: one
    aggregation of sketches, and a margin for their error."""
    counts = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    wide = {c: counts[c] for c in cols if counts[c] > 1.1 * most}
    if wide:
        raise ValueError(f"too many categories to index: {wide}; group rare values first")


def fit(df: DataFrame, kind: str = "forest", **params) -> PipelineModel:
    """M7."""
    check_categories(df)
    return risk_pipeline(kind, **params).fit(df)


def fit_kept(train: DataFrame, kind: str = "forest", **params) -> PipelineModel:
    """M7 on training rows with nulls as 0, in tasks of about ``ROWS_PER_TASK`` rows at most. MLlib reads the
    rows once per fitting pass; what it reads of them is kept for the fit only."""
    train = spread(train).select(*MODEL_COLUMNS).fillna(0, subset=[*NUMERIC_FEATURES, LABEL]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return fit(train, kind=kind, **params)
    finally:
        train.unpersist()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M8."""
    return model.transform(df)


def with_risk(scored: DataFrame) -> DataFrame:
    """``proba`` = P(class 1) as float, working columns removed. The vector element
    is read with a built-in function, not a Python UDF."""
    return scored.withColumn("proba", vector_element("probability", 1)).drop(*WORK_COLUMNS)


def evaluate_auc(scored: DataFrame, label: str = LABEL) -> float:
    """M9 for models: exact area under ROC from MLlib (numBins=0: no down-sampling)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(scored)


def save_model(model: PipelineModel, path: str) -> str:
    """M12."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """M12."""
    return PipelineModel.load(path)


def fits_at_once(df: DataFrame, most: int) -> int:
    """Fits to run side by side: enough to give every core three tasks, at most ``most``. A fit of many
    tasks fills the cores by itself, and each further one would keep another copy of the rows."""
    return max(1, min(most, -(-3 * df.sparkSession.sparkContext.defaultParallelism // max(1, df.rdd.getNumPartitions()))))


def grid_search(df: DataFrame, folds: int = 5, seed: int = 7, kind: str = "gbt",
                grid: dict | None = None, parallelism: int = 4, **params) -> tuple[PipelineModel, DataFrame]:
    """K-fold search over a parameter grid, scored by area under ROC. Folds are
    assigned by a hash of the row, so they do not depend on partitioning. Returns the best
    model refitted on all rows and a (params, auc) table.

    Indexes, one-hot slots and vectors depend on a fold's rows and not on the grid: they are fitted
    and written to the cache once a fold, and the learners of the grid read them from there. A learner
    keeps its rows in memory, so no more fits run side by side than ``fits_at_once`` allows."""
    *encoding, learner = risk_pipeline(kind, **params).getStages()
    if grid is None:
        grid = {"stepSize": [0.1, 0.3], "maxDepth": [3, 6]} if kind == "gbt" else {"maxDepth": [3, 6]}
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(learner.getParam(name), values)
    maps = builder.build()
    spark = df.sparkSession
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, numBins=0)
    folded = spread(df).withColumn("__fold", (F.abs(F.xxhash64(*df.columns, F.lit(seed))) % folds).cast("int"))
    folded = folded.select(*MODEL_COLUMNS, "__fold").persist(StorageLevel.MEMORY_AND_DISK)

    def encoded(model: PipelineModel, part: DataFrame) -> DataFrame:
        return model.transform(part).select("features", LABEL).persist(StorageLevel.MEMORY_AND_DISK)

    def fold_metrics(fold: int) -> list[float]:
        train, held = folded.filter(F.col("__fold") != fold), folded.filter(F.col("__fold") == fold)
        for part, name in ((train, "training"), (held, "validation")):
            if part.isEmpty():
                raise ValueError(f"The {name} data at fold {fold} is empty.")
        encoder = Pipeline(stages=encoding).fit(train)
        train, held = encoded(encoder, train), encoded(encoder, held)
        try:
            score_one = lambda m: evaluator.evaluate(learner.fit(train, m).transform(held))
            with ThreadPool(fits_at_once(train, parallelism)) as pool:
                return pool.map(inheritable_thread_target(spark)(score_one), maps, chunksize=1)
        finally:
            train.unpersist()
            held.unpersist()

    try:
        metrics = [sum(column) / folds for column in zip(*[fold_metrics(fold) for fold in range(folds)])]
        best = max(range(len(maps)), key=metrics.__getitem__)
        encoder = Pipeline(stages=encoding).fit(folded)
        every = encoded(encoder, folded)
        try:
            model = PipelineModel([*encoder.stages, learner.fit(every, maps[best])])
        finally:
            every.unpersist()
    finally:
        folded.unpersist()
    rows = [(", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)), float(a))
            for m, a in zip(maps, metrics)]
    return model, spark.createDataFrame(rows, "params string, auc double")


def importances(model: PipelineModel, scored: DataFrame, features: str = "features") -> DataFrame:
    """(feature, importance) scaled to 100 x value / max, largest first; names are the
    assembler's slot names (numeric column or ``<column>Vec_<category>``)."""
    learner = model.stages[-1]
    values = learner.featureImportances.toArray().tolist()
    meta = scored.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in meta.values() for a in group}
    top = max(values) if values and max(values) > 0 else 1.0
    rows = [(names.get(i, f"f{i}"), 100.0 * v / top) for i, v in enumerate(values)]
    out = scored.sparkSession.createDataFrame(rows, "feature string, importance double")
    return out.orderBy(F.col("importance").desc(), F.col("feature"))


def train_risk(history: DataFrame, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED, kind: str = "forest",
               key: Sequence[str] = ("property_id", "resultdttm")) -> tuple[PipelineModel, DataFrame]:
    """C4: split by a hash of the key, fill training nulls with 0, fit, and return (model,
    scored test rows); ``evaluate_auc`` of those gives the held-out AUC. The test side is not
    read until its rows are used."""
    keyed = history.withColumn("__key", F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    df = training_frame(keyed)
    train, test = hash_split(df, "__key", share, seed)
    model = fit_kept(train, kind=kind)
    return model, score(model, test)


def predict_risk(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Score entity feature rows and keep the entity columns plus ``proba``."""
    return with_risk(score(model, features))


def slots_long(scored: DataFrame, key: str, vec: str) -> DataFrame:
    """Long form of a vector column: (key, slot, value) for the non-zero slots."""
    return scored.select(key, F.posexplode(vector_to_array(F.col(vec))).alias("slot", "value")).filter(
        F.col("value") != 0
    )


