"""Evaluation metrics as aggregations.

All three are one distributed pass: MSE and accuracy are plain averages;
area under ROC is computed from per-score positive/negative counts and
distributed prefix sums (no global sort into a single task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.columns import match_flag
from opinio.operators.aggregate import ROWS_A_RANGE, prefix_sums


def mse(df: DataFrame, prediction: str = "prediction", label: str = "label",
        by: list[str] | None = None, alias: str = "mse") -> DataFrame:
    e = F.avg(F.pow(F.col(prediction) - F.col(label), 2)).alias(alias)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def accuracy(df: DataFrame, prediction: str = "prediction",
             label: str = "label", by: list[str] | None = None,
             alias: str = "accuracy") -> DataFrame:
    e = F.avg(match_flag(prediction, label)).alias(alias)
    return df.groupBy(*by).agg(e) if by else df.agg(e)


def area_under_roc(df: DataFrame, score: str, label: str,
                   by: list[str] | None = None, rows_per_range: int = ROWS_A_RANGE,
                   alias: str = "auc") -> DataFrame:
    """Probability that a random positive outscores a random negative, ties
    counting one half (= trapezoidal ROC area over distinct scores, as
    ``BinaryClassificationEvaluator`` with ``numBins=0``).

    Rows are first reduced to one row per (group, distinct score) -- so a
    score value shared by a third of all rows is one row -- then each row
    needs the number of negatives with a smaller score: a distributed
    prefix sum over score ranges.
    """
    by = list(by or [])
    y = F.col(label).cast("double")
    counts = df.where(F.col(score).isNotNull() & y.isNotNull()).groupBy(
        *by, F.col(score).cast("double").alias("_score")).agg(
        F.sum((y == 1).cast("long")).alias("pos"),
        F.sum((y == 0).cast("long")).alias("neg"))
    ps = prefix_sums(counts, "_score", ["neg"], by=by, rows_per_range=rows_per_range)
    area = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5))
    return ps.groupBy(*by).agg(
        F.try_divide(area, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias(alias))
