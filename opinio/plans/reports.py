"""The reference's three analyses as single calls over a cleaned review
table (any layout described by a ``ReviewSpec``).

* ``rating_models``   -- ratings -> logistic regression and random forest:
  AUC per split, coefficient and importance tables (M4-M8, E3, O1).
* ``text_sentiment``  -- review text -> lexicon baseline accuracy, TF-IDF,
  3 x 3 grid of logistic regressions, best model, per-entity mean +- 2 SE for
  entities with more than ``busy_threshold`` reviews (E4-E6, M9-M14).

Each returns a dict of DataFrames; only model parameters and the grid's
accuracies pass through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.columns import match_flag
from opinio.operators.aggregate import best_by
from opinio.operators.partition import persist_for_iterations
from opinio.operators.split import hash_split
from opinio.plans import classify as CL
from opinio.plans import lexicon as lx
from opinio.plans import metrics as M
from opinio.plans import textmodels as TM
from opinio.specs import ELASTIC_NET_PARAMS, REG_PARAMS, ReviewSpec


def rating_models(spark: SparkSession, df: DataFrame, spec: ReviewSpec,
                  features: list[str] | None = None, seed: int = 42,
                  split_col: str = "split") -> dict[str, DataFrame]:
    """``df``: filled ratings with a ``split`` column (see
    ``reviews.model_ready``). Default features: the sub-ratings without
    the overall rating."""
    feats = list(features or spec.rating_cols[1:])
    data = persist_for_iterations(
        df.withColumn(spec.label_col, F.col(spec.label_col).cast("double")))
    train = data.where(F.col(split_col) == "train")
    lr = CL.logreg_estimator(feats, spec.label_col, 0.1).fit(train)
    rf = CL.forest_estimator(feats, spec.label_col, seed=seed).fit(train)
    out = {
        "logreg_weights": CL.logreg_weights(spark, lr, feats),
        "forest_importances": CL.forest_importances(spark, rf, feats),
        "forest_trees": CL.forest_trees(spark, rf),
    }
    for name, model in (("logreg_auc", lr), ("forest_auc", rf)):
        scored = CL.positive_probability(model.transform(data), "score")
        out[name] = M.area_under_roc(scored, "score", spec.label_col, by=[split_col])
    return out


def text_sentiment(spark: SparkSession, reviews: DataFrame, spec: ReviewSpec,
                   lexicon: DataFrame, stop_words: list[str],
                   busy_threshold: int = 500, key: str | None = None,
                   reg_params=REG_PARAMS, elastic_nets=ELASTIC_NET_PARAMS
                   ) -> dict[str, DataFrame]:
    """``reviews``: cleaned, labelled reviews (entity, text, label, key)."""
    key = key or spec.key_col
    ent, txt, lab = spec.entity_col, spec.text_col, spec.label_col
    base = hash_split(reviews.where(F.col(txt).isNotNull()), key).withColumn(
        lab, F.col(lab).cast("double"))
    polarity = lx.entity_sentiment(base, ent, txt, lexicon)
    out = {
        "lexicon_polarity": polarity,
        "lexicon_accuracy": lx.lexicon_accuracy(base, ent, lab,
                                                polarity.select(ent, "predicted")),
    }
    terms, feats = TM.featurize(base, key, txt, stop_words,
                                [key, ent, lab, "split"],
                                fit_filter=F.col("split") == "train")
    grid, models = TM.grid_search(spark, feats.where(F.col("split") == "train"),
                                  feats.where(F.col("split") == "validation"),
                                  lab, reg_params, elastic_nets)
    best_idx = best_by(grid, "accuracy", ["grid_index"]).first()["grid_index"]
    best = models[best_idx]
    scored = best.transform(feats)
    out.update({
        "grid": grid,
        "word_weights": TM.word_weights(terms, best),
        "test_accuracy": scored.where(F.col("split") == "test").agg(
            F.avg(match_flag("prediction", lab)).alias("accuracy")),
        "scored": scored.select(key, ent, lab, "split", "prediction"),
        "entity_report": TM.entity_report(scored, ent, busy_threshold),
    })
    return out
