"""Scores of tree models computed anew from their saved nodes, without MLlib's scoring code.

``saved_nodes`` reads a saved model's nodes as a table; ``recomputed_score`` turns them into one
expression per tree over the assembled features (a nested ``CASE``), so a check of a model's scores
is a column of the same row: no join and no shuffle. The nodes are bounded by trees x 2^(depth + 1).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrisk.ml.model import save_model
from sparkrisk.session import shared_dir

# Most nodes that are taken to the driver: far above 20 trees of depth 5.
MAX_NODES = 200_000


def saved_nodes(spark: SparkSession, path: str) -> DataFrame:
    """(tree, weight, node, leaf, feature, values, categories, left, right, share, prediction) of the
    tree model in a saved chain; ``share`` is the part of the node's training rows in class 1."""
    learner = f"{path}/stages/*Classifier_*"
    nodes = spark.read.parquet(f"{learner}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{learner}/treesMetadata").toDF("treeID", "metadata", "weight")
    stats = F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return nodes.join(weights.select("treeID", "weight"), "treeID").select(
        F.col("treeID").alias("tree"), "weight", F.col("id").alias("node"), (F.col("leftChild") < 0).alias("leaf"),
        F.col("split.featureIndex").alias("feature"), F.col("split.leftCategoriesOrThreshold").alias("values"),
        F.col("split.numCategories").alias("categories"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
        (stats[1] / total).alias("share"), "prediction")


def _expression(nodes: dict, node: int, value: str, slots: str) -> str:
    """SQL of the value that a row reaches from ``node`` on."""
    n = nodes[node]
    if n["leaf"]:
        return f"{n[value]!r}D"
    x = f"{slots}[{n['feature']}]"
    if n["categories"] < 0:
        goes_left = f"{x} <= {n['values'][0]!r}D"
    else:  # the categories that go left
        goes_left = f"{x} IN ({', '.join(f'{v!r}D' for v in n['values'])})" if n["values"] else "false"
    left, right = (_expression(nodes, n[side], value, slots) for side in ("left", "right"))
    return f"CASE WHEN {goes_left} THEN {left} ELSE {right} END"


def recomputed_score(scored: DataFrame, model: PipelineModel, kind: str = "forest", features: str = "features",
                     out: str = "recomputed") -> DataFrame:
    """``scored`` with the probability of class 1, computed from the model's saved nodes: for a forest
    the mean of the leaves' shares, for boosted trees the logistic of twice the weighted sum."""
    spark = scored.sparkSession
    saved = saved_nodes(spark, save_model(model, shared_dir(spark, "recompute")))
    rows = saved.limit(MAX_NODES + 1).collect()
    if len(rows) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes to recompute")
    trees: dict[int, dict] = {}
    weight = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["node"]] = r
        weight[r["tree"]] = r["weight"]
    value = "share" if kind == "forest" else "prediction"
    # A column first: inside the trees it would be taken from the vector for every split.
    wide = scored.withColumn("__slots", vector_to_array(features))
    parts = [F.expr(f"{weight[t]!r}D * ({_expression(trees[t], 0, value, '__slots')})") for t in sorted(trees)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    score = total / sum(weight.values()) if kind == "forest" else 1 / (1 + F.exp(-2 * total))
    return wide.withColumn(out, score).drop("__slots")
