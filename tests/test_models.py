"""Property tests for the iterative models (no SQL form)."""

import os

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from opinio.catalog import QUERIES, SUB_RATINGS, _labelled_double
from opinio.plans import classify as CL
from opinio.plans import textmodels as TM
from opinio.session import scratch_path


@pytest.fixture(scope="module")
def labelled(spark):
    return _labelled_double(spark, SF_MID).cache()


def test_logreg_mean_probability_is_label_rate(spark, labelled):
    train = labelled.where("split = 'train'")
    model = CL.logreg_estimator(SUB_RATINGS[:3], "label", 0.1).fit(train)
    s = CL.positive_probability(model.transform(train)).agg(
        F.avg("score").alias("p"), F.avg("label").alias("y")).first()
    assert s.p == pytest.approx(s.y, abs=1e-6)


def test_forest_properties(spark, labelled):
    train = labelled.where("split = 'train'")
    m1 = CL.forest_estimator(SUB_RATINGS, "label", seed=7).fit(train)
    m2 = CL.forest_estimator(SUB_RATINGS, "label", seed=7).fit(train)
    imp1 = m1.stages[-1].featureImportances.toArray()
    assert len(m1.stages[-1].trees) == 20
    assert (imp1 >= 0).all() and imp1.sum() == pytest.approx(1.0, abs=1e-9)
    assert np.array_equal(imp1, m2.stages[-1].featureImportances.toArray())
    trees = CL.forest_trees(spark, m1).collect()
    assert len(trees) == 20 and all(t.depth <= 5 for t in trees)


def test_weight_tables_sorted_and_named(spark):
    w = QUERIES["rating_weights"](spark, SF_SMALL).collect()
    assert [r.weight for r in w] == sorted(r.weight for r in w)
    named = QUERIES["weight_display_names"](spark, SF_SMALL).collect()
    assert {r.column: r.display for r in named}["p_retailprice"] == "RETAIL PRICE"
    one = QUERIES["weight_lookup"](spark, SF_SMALL).collect()
    assert [r.column for r in one] == ["p_retailprice"]


def test_grid_search_properties(spark):
    res = QUERIES["grid_search"](spark, SF_MID).orderBy("grid_index").collect()
    assert len(res) == 9
    assert [(r.reg_param, r.elastic_net_param) for r in res][:4] == [
        (0.0, 0.0), (0.0, 0.2), (0.0, 0.4), (0.01, 0.0)]
    # regParam 0: one model whatever the elastic-net mix
    assert res[0].accuracy == res[1].accuracy == res[2].accuracy
    best = [r for r in res if r.is_best]
    assert len(best) == 1
    top = max(r.accuracy for r in res)
    assert best[0].grid_index == min(r.grid_index for r in res if r.accuracy == top)


def test_more_l1_gives_no_fewer_zero_weights(spark):
    from opinio.catalog import _review_features
    _, feats = _review_features(spark, SF_MID, "train")
    train = feats.where("split = 'train'")
    zeros = []
    for en in (0.1, 0.5, 1.0):
        lr = TM.logreg("quality", 0.05, en, 50).fit(train)
        zeros.append(int((lr.coefficients.toArray() == 0).sum()))
    feats.unpersist()
    assert zeros == sorted(zeros)


def test_entity_report_threshold(spark):
    rep = QUERIES["entity_report"](spark, SF_MID).collect()
    assert rep and all(r.review_count > 15 for r in rep)
    assert all(0.0 <= r.prediction <= 1.0 for r in rep)


def test_pipeline_save_and_load(spark, labelled):
    """A fitted pipeline survives save / load unchanged."""
    train = labelled.where("split = 'train'")
    model = CL.logreg_estimator(SUB_RATINGS, "label", 0.1).fit(train)
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = model.transform(train).select("prediction").collect()
    b = back.transform(train).select("prediction").collect()
    assert a == b and os.path.basename(path)


def test_random_split_is_disjoint_and_complete(spark):
    out = QUERIES["random_split"](spark, SF_MID)
    n = out.count()
    assert n == out.select("doc_id").distinct().count()
    shares = {r.split: r.c / n for r in out.groupBy("split").agg(
        F.count(F.lit(1)).alias("c")).collect()}
    assert abs(shares["train"] - 0.6) < 0.1
