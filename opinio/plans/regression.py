"""Least squares on rating columns (T8, M1-M3, M16, E1) and the
feature-subset comparison report (M2).

Single fits use Spark ML (``VectorAssembler`` + ``LinearRegression``, the
normal-equation solver: one aggregation pass). The subset report needs 13
fits and 13 scorings over the same table; instead of 26 passes it takes
ONE pass -- count, means and the centred Gram matrix of
label and features per split, by Arrow batch -- and solves every subset from those
moments on the driver (a (k+1)^2 matrix per split, independent of the row
count). Exact, not sampled: OLS and its MSE are functions of these moments.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy


def assemble(df: DataFrame, features: list[str],
             out: str = "features") -> DataFrame:
    """Dense feature vector from named columns (NULL/NaN must be filled
    first; the assembler rejects them)."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


def unpack(df: DataFrame, vec: str, names: list[str],
           keep: list[str]) -> DataFrame:
    """Vector column -> one double column per element."""
    arr = vector_to_array(F.col(vec))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def ols_estimator(features: list[str], label: str) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=label,
                         solver="normal"),
    ])


def fit_ols(df: DataFrame, features: list[str], label: str) -> PipelineModel:
    return ols_estimator(features, label).fit(df)


def coefficient_table(spark: SparkSession, model: PipelineModel,
                      features: list[str]) -> DataFrame:
    """``(column, weight)`` rows plus an ``intercept`` row."""
    lr = model.stages[-1]
    rows = [(c, float(w)) for c, w in zip(features, lr.coefficients.toArray())]
    rows.append(("intercept", float(lr.intercept)))
    return spark.createDataFrame(rows, "column string, weight double")


def standardize(fit_df: DataFrame, apply_df: DataFrame, features: list[str],
                keep: list[str], prefix: str = "z_") -> DataFrame:
    """(x - mean) / sample stddev with statistics from ``fit_df``."""
    va = VectorAssembler(inputCols=list(features), outputCol="_raw")
    scaler = StandardScaler(withMean=True, withStd=True, inputCol="_raw",
                            outputCol="_z")
    model = Pipeline(stages=[va, scaler]).fit(fit_df)
    return unpack(model.transform(apply_df), "_z",
                  [prefix + f for f in features], keep)


# ---------------------------------------------------------- moments ----

MERGERS = 32  # tasks that put the tasks' moments together; the driver gets so many rows a split at most
MOMENTS = "n bigint, mean array<double>, scatter array<double>"


def merge_moments(a: tuple | None, b: tuple) -> tuple:
    """(n, mean, scatter about the mean) of two disjoint sets of rows."""
    if a is None:
        return b
    n, off = a[0] + b[0], b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * b[0] / n)


def split_moments(df: DataFrame, cols: list[str], split_col: str) -> dict:
    """Per split: n, mean vector and population covariance matrix of
    ``cols`` as a blocked Gram matrix: each Arrow batch is centred on its own means and multiplied with
    itself, a task merges its batches, MERGERS tasks merge those. A hot split is a few matrices a task.
    Rows with a missing value in any column are left out as a whole (fill
    first), so every moment is over the same rows. A NULL split is one of its own; without rows there is none."""
    k = len(cols)
    rows = df.na.drop(subset=list(cols)).select(
        F.col(split_col).alias("split"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    kind = rows.schema["split"].dataType.simpleString()

    def flat(held: dict) -> dict:
        return {"n": [m[0] for m in held.values()], "mean": [m[1] for m in held.values()],
                "scatter": [m[2].ravel() for m in held.values()]}

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            x = np.column_stack([batch[f"c{i}"].to_numpy() for i in range(k)])
            coded = batch["split"].dictionary_encode()
            code = coded.indices.fill_null(len(coded.dictionary)).to_numpy()
            for c, name in enumerate([*coded.dictionary.to_pylist(), None]):
                own = x[code == c]
                if len(own):
                    mean = own.mean(0)
                    own = own - mean
                    held[name] = merge_moments(held.get(name), (len(own), mean, own.T @ own))
        if held:
            yield pa.RecordBatch.from_pydict({"split": pa.array(list(held), batch.schema.field("split").type), **flat(held)})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = None
        for n, mean, scatter in zip(group["n"], group["mean"], group["scatter"]):
            total = merge_moments(total, (n, np.asarray(mean), np.asarray(scatter).reshape(k, k)))
        return pd.DataFrame({"split": group["split"].iloc[:1], "n": [total[0]], "mean": [total[1]], "scatter": [total[2].ravel()]})

    parts = rows.mapInArrow(blocks, f"split {kind}, {MOMENTS}")
    merged = (parts.withColumn("merger", F.pmod(F.spark_partition_id(), F.lit(MERGERS)))
              .groupBy("split", "merger").applyInPandas(merge, f"split {kind}, {MOMENTS}"))
    held: dict = {}
    for row in merged.collect():
        held[row["split"]] = merge_moments(held.get(row["split"]), (row["n"], np.array(row["mean"]), np.array(row["scatter"]).reshape(k, k)))
    return {name: {"n": n, "mean": mean, "cov": scatter / n} for name, (n, mean, scatter) in held.items()}


def ols_from_moments(mom: dict, y: int, xs: list[int]):
    """OLS slope vector and intercept of column ``y`` on columns ``xs``."""
    cov, mean = mom["cov"], mom["mean"]
    sxx = cov[np.ix_(xs, xs)]
    sxy = cov[xs, y]
    d = np.sqrt(np.diag(sxx))
    d[d == 0] = 1.0
    corr = sxx / np.outer(d, d)
    b_scaled = np.linalg.lstsq(corr, sxy / d, rcond=None)[0]
    b = b_scaled / d
    b0 = mean[y] - b @ mean[xs]
    return b, b0


def mse_from_moments(mom: dict, y: int, xs: list[int], b, b0) -> float:
    """Mean of (y - b0 - b.x)^2 over a split = Var(y - b.x) + (mean - b0)^2."""
    idx = [y] + list(xs)
    c = np.concatenate([[1.0], -np.asarray(b)])
    sub = mom["cov"][np.ix_(idx, idx)]
    resid_mean = c @ mom["mean"][idx]
    return float(c @ sub @ c + (resid_mean - b0) ** 2)


REPORT_SCHEMA = T.StructType([
    T.StructField("run", T.IntegerType()),
    T.StructField("features", T.StringType()),
    T.StructField("fit_on", T.StringType()),
    T.StructField("score_on", T.StringType()),
    T.StructField("n_fit", T.LongType()),
    T.StructField("n_score", T.LongType()),
    T.StructField("mse", T.DoubleType()),
])


def subset_mse_report(spark: SparkSession, df: DataFrame, label: str,
                      runs: list[tuple[list[str], str, str]],
                      split_col: str = "split") -> DataFrame:
    """One row per run: features, fit split, score split, sizes, MSE.

    ``runs`` = [(feature columns, fit split, score split), ...]."""
    cols = [label] + sorted({f for fs, _, _ in runs for f in fs})
    pos = {c: i for i, c in enumerate(cols)}
    mom = split_moments(df.select(split_col, *cols), cols, split_col)
    rows = []
    for n, (fs, fit_on, score_on) in enumerate(runs, start=1):
        xs = [pos[f] for f in fs]
        b, b0 = ols_from_moments(mom[fit_on], 0, xs)
        m = mse_from_moments(mom[score_on], 0, xs, b, b0)
        rows.append((n, ",".join(fs), fit_on, score_on, int(mom[fit_on]["n"]),
                     int(mom[score_on]["n"]), m))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def subset_coefficients(spark: SparkSession, df: DataFrame, label: str,
                        runs: list[tuple[list[str], str, str]],
                        split_col: str = "split") -> DataFrame:
    """``(run, column, weight)`` for each run, intercept included, from the
    same one-pass moments."""
    cols = [label] + sorted({f for fs, _, _ in runs for f in fs})
    pos = {c: i for i, c in enumerate(cols)}
    mom = split_moments(df.select(split_col, *cols), cols, split_col)
    rows = []
    for n, (fs, fit_on, _) in enumerate(runs, start=1):
        b, b0 = ols_from_moments(mom[fit_on], 0, [pos[f] for f in fs])
        rows += [(n, f, float(w)) for f, w in zip(fs, b)]
        rows.append((n, "intercept", float(b0)))
    return spark.createDataFrame(rows, "run int, column string, weight double")


def ols_subset_report(spark: SparkSession, df: DataFrame, spec,
                      runs=None, split_col: str = "split") -> DataFrame:
    """The OLS subset comparison for a review layout: ``runs`` as (feature
    columns, fit split, score split), by default those of ``spec``."""
    runs = runs or spec.ols_runs
    if not runs:
        raise ValueError("this layout has no OLS runs of its own: pass runs by column names")
    return subset_mse_report(spark, df, spec.label_col,
                             [(list(names), fit, score) for names, fit, score in runs], split_col)
