"""Moments by blocks against numpy, and reports that rest on them."""

import numpy as np
import pytest

from opinio.plans import regression as RG


def _frame(spark, x, splits, partitions=7):
    rows = [(s, *[None if np.isnan(v) else float(v) for v in r]) for s, r in zip(splits, x)]
    return spark.createDataFrame(rows, "split string, a double, b double, c double").repartition(partitions)


def test_moments_equal_numpy(spark):
    """A far offset, a constant column, missing values, a NULL split, one row of a split, more tasks than rows of it."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((900, 3)) * [1, 50, 0] + [1e6, 0, 3]
    x[rng.integers(0, 900, 60), rng.integers(0, 3, 60)] = np.nan
    splits = np.array(rng.choice(["train", "train", "test", None], 900), object)
    splits[17], x[17] = "one", 1.0
    df = _frame(spark, x, splits, partitions=40)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = RG.split_moments(df, ["a", "b", "c"], "split")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(got) == {"train", "test", None, "one"}
    whole = ~np.isnan(x).any(1)
    for name, m in got.items():
        own = x[whole & np.array([s == name for s in splits])]
        assert m["n"] == len(own)
        assert m["mean"] == pytest.approx(own.mean(0), rel=1e-13)
        assert m["cov"] == pytest.approx(np.cov(own.T, bias=True), rel=1e-9, abs=1e-9)


def test_moments_of_no_rows(spark):
    df = _frame(spark, np.full((4, 3), np.nan), ["train"] * 4)
    assert RG.split_moments(df, ["a", "b", "c"], "split") == {}
    assert RG.split_moments(df.limit(0), ["a", "b", "c"], "split") == {}
