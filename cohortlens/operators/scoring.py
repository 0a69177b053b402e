"""Fitted models as tables, and their scores as plain expressions.

A model's coefficients or tree nodes become rows that can be kept, compared and joined. The
same rows, folded into one, score a vector with built-in higher-order functions, without
the model object; tests hold the two against each other on every row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LinearSVCModel,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.shared import fresh_path

NODES = "tree int, weight double, node int, feature int, threshold double, left int, right int, value double"


def weight_table(spark: SparkSession, model) -> DataFrame:
    """(layer, unit, input, weight) of a linear model or a perceptron; the intercept has input -1."""
    if isinstance(model, MultilayerPerceptronClassificationModel):
        flat, sizes, rows, at = model.weights.toArray().tolist(), model.getLayers(), [], 0
        for layer, (n, m) in enumerate(zip(sizes, sizes[1:])):
            # inputs vary slowest, the intercepts follow
            rows += [(layer, u, i, flat[at + i * m + u]) for i in range(n) for u in range(m)]
            rows += [(layer, u, -1, flat[at + n * m + u]) for u in range(m)]
            at += (n + 1) * m
    elif isinstance(model, (LogisticRegressionModel, LinearSVCModel)):
        rows = [(0, 0, i, float(w)) for i, w in enumerate(model.coefficients.toArray())] + [(0, 0, -1, float(model.intercept))]
    else:
        raise TypeError(f"{type(model).__name__} has no weights")
    return spark.createDataFrame(rows, "layer int, unit int, input int, weight double")


def node_table(spark: SparkSession, model) -> DataFrame:
    """The nodes of a forest or of boosted trees, as the model's own files hold them.

    ``value`` is a tree's answer at the node: the share of positives in a forest, the
    prediction in boosted trees. Leaves have no feature and point at themselves.
    """
    if not isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)):
        raise TypeError(f"{type(model).__name__} has no trees")
    path = fresh_path(spark, "trees")
    model.write().save(path)
    n, stats = F.col("nodeData"), F.col("nodeData.impurityStats")
    share = F.try_divide(stats[1], F.aggregate(stats, F.lit(0.0), lambda a, x: a + x))
    leaf = n["leftChild"] < 0
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.treeWeights)], "treeID int, weight double")
    rows = spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID")  # a row a tree
    return rows.select(
        F.col("treeID").alias("tree"), "weight", n["id"].alias("node"), F.when(~leaf, n["split"]["featureIndex"]).alias("feature"),
        F.when(~leaf, F.when(n["split"]["numCategories"] < 0, n["split"]["leftCategoriesOrThreshold"][0]).otherwise(
            F.raise_error(F.lit("the features of these trees are numbers")).cast("double"))).alias("threshold"),
        F.when(leaf, n["id"]).otherwise(n["leftChild"]).alias("left"), F.when(leaf, n["id"]).otherwise(n["rightChild"]).alias("right"),
        (F.coalesce(share, F.lit(0.0)) if isinstance(model, RandomForestClassificationModel) else n["prediction"]).alias("value"))


def _dot(weights: Column, inputs: Column) -> Column:
    return F.aggregate(F.zip_with(weights, inputs, lambda w, x: w * x), F.lit(0.0), lambda a, x: a + x)


def _logistic(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def packed_weights(weights: DataFrame) -> DataFrame:
    """One row: a list of layers, each a list of units (bias, weights)."""
    w = F.sort_array(F.collect_list(F.when(F.col("input") >= 0, F.struct("input", "weight"))))
    units = weights.groupBy("layer", "unit").agg(
        F.max(F.when(F.col("input") < 0, F.col("weight"))).alias("bias"), F.transform(w, lambda s: s["weight"]).alias("w"))
    layers = units.groupBy("layer").agg(F.transform(F.sort_array(F.collect_list(F.struct("unit", "bias", "w"))), lambda u: F.struct(u["bias"].alias("bias"), u["w"].alias("w"))).alias("units"))
    return layers.agg(F.transform(F.sort_array(F.collect_list(F.struct("layer", "units"))), lambda x: x["units"]).alias("packed"))


def packed_nodes(nodes: DataFrame) -> DataFrame:
    """One row: a list of trees, each with its weight and its nodes in order."""
    trees = nodes.groupBy("tree").agg(F.first("weight").alias("weight"), F.sort_array(F.collect_list(
        F.struct("node", F.coalesce("feature", F.lit(0)).alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"), "left", "right", "value"))).alias("nodes"))
    return trees.agg(F.sort_array(F.collect_list(F.struct("tree", "weight", "nodes"))).alias("packed"))


def linear_score(packed: Column, inputs: Column, *, probability: bool) -> Column:
    unit = packed[0][0]
    margin = _dot(unit["w"], inputs) + unit["bias"]
    return _logistic(margin) if probability else margin


def network_score(packed: Column, inputs: Column, depth: int) -> Column:
    """Probability of the second class: logistic layers, then the soft maximum of two units."""
    def units(fed: Column):
        return lambda u: _dot(u["w"], fed) + u["bias"]

    values = inputs
    for k in range(depth):
        values = F.transform(packed[k], units(values))
        if k < depth - 1:
            values = F.transform(values, _logistic)
    return _logistic(values[1] - values[0])


def tree_score(packed: Column, inputs: Column, depth: int, *, boosted: bool) -> Column:
    """Every tree is walked from its root, ``depth`` steps; a leaf holds what reaches it."""
    def answer(t: Column) -> Column:
        def step(at: Column, _: Column) -> Column:
            here = F.get(t["nodes"], at)
            return F.when(F.get(inputs, here["feature"]) <= here["threshold"], here["left"]).otherwise(here["right"])

        return F.get(t["nodes"], F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step))["value"]

    total = F.aggregate(packed, F.lit(0.0), lambda a, t: a + (t["weight"] * answer(t) if boosted else answer(t)))
    return _logistic(2 * total) if boosted else total / F.size(packed)


def with_table_score(frame: DataFrame, model, into: str = "table_score", features: str = "features") -> DataFrame:
    """The frame with a fitted classifier's score from its own table of weights or nodes.

    The table is folded into one row beside the rows to score: its size is the model's.
    """
    spark, inputs, packed = frame.sparkSession, vector_to_array(features), F.col("_packed")
    if isinstance(model, (RandomForestClassificationModel, GBTClassificationModel)):
        folded = packed_nodes(node_table(spark, model))
        value = tree_score(packed, F.col("_inputs"), max(t.depth for t in model.trees), boosted=isinstance(model, GBTClassificationModel))
    else:
        folded = packed_weights(weight_table(spark, model))
        value = (network_score(packed, F.col("_inputs"), len(model.getLayers()) - 1) if isinstance(model, MultilayerPerceptronClassificationModel)
                 else linear_score(packed, F.col("_inputs"), probability=isinstance(model, LogisticRegressionModel)))
    return frame.withColumns({"_packed": folded.scalar(), "_inputs": inputs}).withColumn(into, value).drop("_packed", "_inputs")


def score_with_tables(model: PipelineModel, frame: DataFrame, keep: Sequence[str] = (), *, label: str = "label") -> DataFrame:
    """Label, the model's score, the score of its table, and the kept columns."""
    out = model.transform(frame)
    source = "probability" if "probability" in out.columns else "rawPrediction"
    narrow = out.select(F.col(label).cast("double").alias(label), vector_to_array(source)[1].alias("score"), "features", *keep)
    return with_table_score(narrow, model.stages[-1]).select(label, "score", "table_score", *keep)
