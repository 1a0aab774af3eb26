"""Fitted pipelines kept as tables (M15), and fitted forests as node tables (M6-M8).

A model is stored under ``<root>/<name>/<version>/`` in the shared folder by Spark ML's own
writer. Its card (one row of JSON: what it is, when it was fitted, whatever the caller adds) is
written last, so a version whose writer died is never seen. Versions rise; a stored version is never
overwritten, so a reader keeps what it loaded. All files go through Spark's readers and writers, so any
store that Spark reaches will do.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.session import checkpoint_root

CARD = ("name string, version bigint, kind string, stages array<string>, spark string, stored_at timestamp, "
        "notes map<string, string>")
MODEL, CARDS = "model", "card"


def store_root(spark: SparkSession, root: str | None = None) -> str:
    return (root or checkpoint_root(spark).rstrip("/") + "/models").rstrip("/")


def versions(spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """The cards of a model's stored versions (no rows where there is none)."""
    try:
        return spark.read.schema(CARD).json(f"{store_root(spark, root)}/{name}/*/{CARDS}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CARD)


def save_model(spark: SparkSession, model, name: str, root: str | None = None, notes: dict[str, str] | None = None) -> int:
    """Store a fitted model as the next version of ``name``; returns the version."""
    last = versions(spark, name, root).agg(F.max("version")).first()[0]
    version = 1 if last is None else last + 1
    folder = f"{store_root(spark, root)}/{name}/{version}"
    # fails where another writer has taken this version
    model.write().save(f"{folder}/{MODEL}")
    stages = [type(s).__name__ for s in getattr(model, "stages", [model])]
    card = [(name, version, type(model).__name__, stages, spark.version, None, dict(notes or {}))]
    (spark.createDataFrame(card, CARD).withColumn("stored_at", F.current_timestamp())
     .coalesce(1).write.json(f"{folder}/{CARDS}"))
    return version


def model_path(spark: SparkSession, name: str, version: int | None = None, root: str | None = None) -> str:
    """Folder of a stored version, the latest by default; raises where it is not there."""
    cards = versions(spark, name, root)
    known = cards.where(F.col("version") == version) if version is not None else cards
    found = known.agg(F.max("version")).first()[0]
    if found is None:
        raise LookupError(f"no stored version {version or ''} of model {name}")
    return f"{store_root(spark, root)}/{name}/{found}/{MODEL}"


def load_model(spark: SparkSession, name: str, version: int | None = None, root: str | None = None):
    """A stored model, the latest version by default."""
    return DefaultParamsReader.loadParamsInstance(model_path(spark, name, version, root), spark)


def forest_nodes(spark: SparkSession, path: str, features: list[str]) -> DataFrame:
    """The trees of a stored forest (or of a stored pipeline whose last stage is one) as a table, one row a node:

    tree, node, depth, feature and threshold (NULL in leaves; a row goes left where its value is at most the
    threshold), left_child, right_child, gain, impurity, n (training rows, weighted by bagging),
    votes (by class), prediction."""
    card = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    if uids := card["paramMap"].get("stageUids"):
        path = f"{path}/stages/{len(uids) - 1:0{len(str(len(uids)))}d}_{uids[-1]}"
    data = spark.read.parquet(f"{path}/data")
    d, inner = F.col("nodeData"), F.col("nodeData.leftChild") >= 0
    names = F.array(*[F.lit(x) for x in features])
    nodes = data.select(
        F.col("treeID").alias("tree"), d["id"].alias("node"),
        F.when(inner, F.get(names, d["split"]["featureIndex"])).alias("feature"),
        F.when(inner, F.get(d["split"]["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner, d["leftChild"]).alias("left_child"), F.when(inner, d["rightChild"]).alias("right_child"),
        F.when(inner, d["gain"]).alias("gain"), d["impurity"].alias("impurity"), d["rawCount"].alias("n"),
        d["impurityStats"].alias("votes"), d["prediction"].alias("prediction"))
    return _with_depth(nodes)


def _with_depth(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the level of each (root: 0): one join a level over the table (at most trees * 2^depth rows)."""
    level, found, depth = nodes.where("node = 0").select("tree", "node", F.lit(0).alias("depth")), None, 0
    while not level.isEmpty():
        found, depth = level if found is None else found.union(level), depth + 1
        below = nodes.join(level.select("tree", "node"), ["tree", "node"]).where("left_child is not null")
        level = below.select("tree", F.explode(F.array("left_child", "right_child")).alias("node"), F.lit(depth).alias("depth"))
    return nodes.join(found, ["tree", "node"])
