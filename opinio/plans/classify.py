"""Classifiers on rating columns (M4-M8) and their weight tables (M5, M7,
O1, P13, P14).

Fitting is Spark ML: logistic regression (L-BFGS, one distributed pass
per iteration) and a random forest (level-wise histogram aggregation).
Only model parameters -- bounded by the number of features and trees --
reach the driver; weight tables are returned as small DataFrames.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators.joins import join_checked

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy


def logreg_estimator(features: list[str], label: str,
                     reg_param: float = 0.1) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label,
                           regParam=reg_param),
    ])


def forest_estimator(features: list[str], label: str, seed: int = 42,
                     num_trees: int = 20, max_depth: int = 5) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(featuresCol="features", labelCol=label,
                               numTrees=num_trees, maxDepth=max_depth,
                               seed=seed),
    ])


def positive_probability(scored: DataFrame, out: str = "score") -> DataFrame:
    """P(label = 1) as a plain double column."""
    return scored.withColumn(out, vector_to_array(F.col("probability"))[1])


def weight_table(spark: SparkSession, names: list[str], weights) -> DataFrame:
    """``(column, weight)`` sorted by weight (ties by column)."""
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return (spark.createDataFrame(rows, "column string, weight double")
            .orderBy("weight", "column"))


def logreg_weights(spark: SparkSession, model: PipelineModel,
                   names: list[str]) -> DataFrame:
    return weight_table(spark, names, model.stages[-1].coefficients.toArray())


def forest_importances(spark: SparkSession, model: PipelineModel,
                       names: list[str]) -> DataFrame:
    return weight_table(spark, names,
                        model.stages[-1].featureImportances.toArray())


def forest_trees(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per tree: index, depth, node count and its printed rules."""
    rf = model.stages[-1]
    rows = [(i, t.depth, t.numNodes, t.toDebugString)
            for i, t in enumerate(rf.trees)]
    return spark.createDataFrame(
        rows, "tree int, depth int, num_nodes int, rules string")


def forest_scores(df: DataFrame, nodes: DataFrame, features: list[str]) -> DataFrame:
    """``df`` with ``forest_score`` (P(label = 1)) and ``forest_prediction`` from a node table
    (``sources.models.forest_nodes``) alone: all trees walk down together, a level at a time, by lookups in
    the table's columns, for an Arrow batch of rows at once. The table (at most trees * 2^depth rows, a model's size) goes
    with the function, so scoring is a map without any shuffle. NULL and NaN go right."""
    rows = nodes.orderBy("tree", "node").select(
        "tree", "node", "depth", "feature", "threshold", "left_child", "right_child", "votes").collect()
    place = {(r.tree, r.node): k for k, r in enumerate(rows)}
    child = lambda k: np.array([place.get((r.tree, r[k]), i) for i, r in enumerate(rows)], np.int32)
    # a leaf's children are itself
    left, right = child("left_child"), child("right_child")
    feature = np.array([features.index(r.feature) if r.feature is not None else 0 for r in rows], np.int32)
    threshold = np.array([r.threshold or 0.0 for r in rows])
    share = np.array([r.votes[1] / sum(r.votes) for r in rows])
    roots = [place[r.tree, r.node] for r in rows if r.depth == 0]
    levels = max((r.depth for r in rows), default=0)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            values = np.column_stack([c.to_numpy(np.float64) for c in columns]).ravel()
            first = np.arange(len(columns[0])) * len(columns)
            total = np.zeros(len(first))
            for root in roots:
                at = np.full(len(first), root, np.int32)
                for _ in range(levels):
                    at = np.where(values[first + feature[at]] <= threshold[at], left[at], right[at])
                total += share[at]
            yield pd.Series(total / len(roots))

    return (df.withColumn("forest_score", score(*[F.col(f).cast("double") for f in features]))
            .withColumn("forest_prediction", (F.col("forest_score") > 0.5).cast("double")))


def gain_importances(nodes: DataFrame, features: list[str]) -> DataFrame:
    """``(column, weight)`` from a node table: each tree's gains, weighted by its nodes' rows, add up to 1;
    then the mean over the trees that split at all."""
    gains = nodes.where("feature is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * F.col("n")).alias("g"))
    whole = gains.groupBy("tree").agg(F.sum("g").alias("all"))
    mean = (gains.join(whole, "tree").groupBy("feature").agg(F.sum(F.col("g") / F.col("all")).alias("s")))
    names = nodes.sparkSession.createDataFrame([(f,) for f in features], "column string")
    total = mean.agg(F.sum("s")).first()[0] or 1.0
    return (names.join(mean, names["column"] == mean["feature"], "left")
            .select("column", (F.coalesce("s", F.lit(0.0)) / F.lit(total)).alias("weight")).orderBy("weight", "column"))


def score_equations(train: DataFrame, model: PipelineModel, features: list[str], label: str, reg_param: float) -> DataFrame:
    """``(equation, value)``: how far a fitted ridge logistic regression is from its optimum. At the optimum the mean of
    (p - y) is 0 (``intercept``), and so is, for every feature, the mean of (p - y) x / deviation plus
    ``reg_param`` times the coefficient of x / deviation. Two aggregations over the training rows."""
    lr = model.stages[-1]
    scored = positive_probability(model.transform(train), "_p").select("_p", F.col(label).cast("double").alias("_y"), *features)
    rest = F.col("_p") - F.col("_y")
    row = scored.agg(F.avg(rest).alias("intercept"), *[F.stddev(f).alias(f"s_{f}") for f in features],
                     *[F.avg(rest * F.col(f)).alias(f"g_{f}") for f in features]).first()
    values = [("intercept", row["intercept"])]
    for f, w in zip(features, lr.coefficients.toArray()):
        spread = row[f"s_{f}"]
        values.append((f, row[f"g_{f}"] / spread + reg_param * float(w) * spread if spread else 0.0))
    return train.sparkSession.createDataFrame(values, "equation string, value double")


def weight_lookup(weights: DataFrame, column: str) -> DataFrame:
    return weights.where(F.col("column") == column)


def with_display_names(weights: DataFrame, names: DataFrame) -> DataFrame:
    """Attach display names by column name (a join, never by position)."""
    return join_checked(weights, names, "column", "left", 100_000)
