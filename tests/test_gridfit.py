"""The grid fitted at once against single fits of Spark ML."""

import pickle

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark import RDD
from pyspark.ml.linalg import Vectors

from opinio.catalog import _review_features
from opinio.plans import gridfit as G
from opinio.plans import textmodels as TM
from opinio.session import scratch_path
from opinio.sources import models
from opinio.specs import ELASTIC_NET_PARAMS, REG_PARAMS

KEYS = sorted({TM.effective_key(r, e) for r in REG_PARAMS for e in ELASTIC_NET_PARAMS})


@pytest.fixture(scope="module")
def train(spark):
    return _review_features(spark, SF_SMALL)[1].where("split = 'train'")


def test_objectives_are_not_above_single_fits(spark, train):
    size = train.first().tfidf.size
    blocks = G.sparse_blocks(train, "quality", "tfidf")
    fits, rounds = G.fit_all(blocks, size, KEYS)
    m = G.moments(blocks, size)
    assert rounds <= 130  # one job a round for all seven models; about 100 iterations at most
    for (reg, mix), fit in zip(KEYS, fits):
        single = TM.logreg("quality", reg, mix).fit(train)

        def objective(coefficients, intercept):
            loss, _, _ = G.losses_and_gradients(blocks, coefficients[None, :], np.array([intercept]))
            scaled = coefficients * m.deviation
            return loss[0] / m.n + reg * ((1 - mix) / 2 * scaled @ scaled + mix * np.abs(scaled).sum())

        ours, theirs = objective(fit.coefficients, fit.intercept), objective(single.coefficients.toArray(), single.intercept)
        assert ours == pytest.approx(fit.objective, rel=1e-9, abs=1e-12)
        assert ours <= theirs * (1 + 1e-6) + 1e-8, (reg, mix)
        if reg:
            assert np.abs(fit.coefficients - single.coefficients.toArray()).max() < 1e-2
    blocks.unpersist()


def test_small_dense_problem(spark):
    """Dense and sparse vectors, a constant feature and an empty row, many small blocks."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 4)) * [1, 10, 0.1, 0] + [0, 5, 0, 3]
    x[7] = 0
    y = (x[:, 0] + x[:, 1] / 10 + rng.standard_normal(300) > 0.5).astype(float)
    rows = [(float(b), Vectors.dense(a) if k % 2 else Vectors.sparse(4, [(j, v) for j, v in enumerate(a) if v])) for k, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ["quality", "tfidf"]).repartition(3)
    for (reg, mix), got in zip([(0.05, 0.0), (0.05, 1.0)], G.fit_grid(df, "quality", [(0.05, 0.0), (0.05, 1.0)])):
        want = TM.logreg("quality", reg, mix).fit(df)
        assert np.allclose(got.coefficients.toArray(), want.coefficients.toArray(), atol=2e-3)
        assert got.intercept == pytest.approx(want.intercept, abs=5e-3)


def test_one_label_raises(spark):
    df = spark.createDataFrame([(1.0, Vectors.dense([1.0]))], ["quality", "tfidf"])
    with pytest.raises(ValueError):
        G.fit_grid(df, "quality", [(0.0, 0.0)])
    with pytest.raises(ValueError):
        G.fit_grid(df.limit(0), "quality", [(0.0, 0.0)])


def test_fitted_models_can_be_stored(spark, train):
    model = G.fit_grid(train, "quality", [(0.02, 0.2)], max_iter=5)[0]
    root = scratch_path(spark, "store")
    models.save_model(spark, model, "lr", root)
    back = models.load_model(spark, "lr", root=root)
    rows = lambda m: m.transform(train).select("doc_id", "prediction").orderBy("doc_id").collect()
    assert rows(back) == rows(model)


def test_the_driver_gets_one_sum(spark):
    """Whatever the number of partitions, what comes to the driver is one tuple."""
    parts = spark.sparkContext.parallelize(range(100), 100).map(lambda x: (float(x), np.full(3, x)))
    collected = []
    real = RDD.collect

    def collect(rdd):
        collected.append(real(rdd))
        return collected[-1]

    RDD.collect = collect
    try:
        total, each = G._tree_sum(parts)
    finally:
        RDD.collect = real
    assert [len(c) for c in collected] == [1]
    assert total == 4950 and each.tolist() == [4950] * 3


def test_rounds_send_no_gradients_to_the_driver(spark, monkeypatch):
    """What reaches the driver is the moments and each model's coefficients once, however many rounds there are."""
    size, rng = 5000, np.random.default_rng(3)
    rows = [(float(k % 2), Vectors.sparse(size, sorted(rng.choice(size, 20, replace=False).tolist()), rng.random(20) + k % 2)) for k in range(60)]
    df = spark.createDataFrame(rows, ["quality", "tfidf"]).repartition(3)
    blocks = G.sparse_blocks(df, "quality", "tfidf")
    sent, real = [], RDD.collect

    def collect(rdd):
        out = real(rdd)
        sent.append(len(pickle.dumps(out)))
        return out

    monkeypatch.setattr(RDD, "collect", collect)
    monkeypatch.setattr(G, "KEPT_EVERY", 4)  # the state passes through the checkpoint folder
    fits, rounds = G.fit_all(blocks, size, [(0.0, 0.0), (0.02, 0.5)], max_iter=12)
    blocks.unpersist()
    assert rounds > 8 and [f.iterations for f in fits]
    assert sum(sent) < (2 + 2) * size * 8 * 1.1 + rounds * 1000
