"""Aggregations, ordering and top-k.

Every aggregate here is algebraic (count / sum / avg / stddev), so Spark
computes partial results before the shuffle: one hot group holding a third
of all rows costs one partial row per input partition, not one huge task.
"""

from __future__ import annotations

import math
from typing import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinio.functions.columns import two_standard_errors


def column_means(df: DataFrame, cols: Iterable[str],
                 prefix: str = "avg_") -> DataFrame:
    """One row: the mean of each column (NULLs ignored)."""
    return df.agg(*[F.avg(c).alias(prefix + c) for c in cols])


def grouped_mean(df: DataFrame, by: str, col: str,
                 alias: str = "avg") -> DataFrame:
    return df.groupBy(by).agg(F.avg(col).alias(alias))


def busy_entities(df: DataFrame, entity: str, threshold: int,
                  count_alias: str = "review_count") -> DataFrame:
    """Entities with more than ``threshold`` rows, most reviewed first."""
    return (df.groupBy(entity)
            .agg(F.count(F.lit(1)).alias(count_alias))
            .where(F.col(count_alias) > threshold)
            .orderBy(F.desc(count_alias), F.asc(entity)))


def mean_with_error(df: DataFrame, by: str, col: str,
                    mean_alias: str = "prediction",
                    err_alias: str = "err",
                    count_alias: str | None = None) -> DataFrame:
    """Per group: mean and 2 standard errors (NULL for one row)."""
    aggs = [F.avg(col).alias(mean_alias),
            two_standard_errors(col).alias(err_alias)]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(by).agg(*aggs)


def zero_weight_summary(weights: DataFrame, weight: str = "weight") -> DataFrame:
    """Count and share of exactly-zero weights, and the total."""
    z = (F.col(weight) == 0).cast("int")
    return weights.agg(
        F.sum(z).cast("bigint").alias("n_zero"),
        F.count(F.lit(1)).alias("n_total"),
        F.avg(z.cast("double")).alias("zero_share"),
    )


def zero_weights(weights: DataFrame, key: str, k: int,
                 weight: str = "weight") -> DataFrame:
    """The first ``k`` zero-weight keys (key order, deterministic)."""
    return weights.where(F.col(weight) == 0).orderBy(key).limit(k)


def marginal_lasso_weights(counts: DataFrame, word: str, n: str, label: str, rows: int, positives: float,
                           penalty: float, min_df: float = 1.0) -> DataFrame:
    """``(word, weight)``: the lasso weight of each word taken alone (least squares of the label on the word's count, over
    all ``rows`` documents, absent words counting 0): the covariance shrunk toward zero by ``penalty``, over the variance.

    A closed form, so exactly-zero weights follow from one aggregation of ``counts`` (a row a document and
    word, with the document's label); ``rows`` and ``positives`` are the number of documents and the sum of their labels."""
    x, y = F.col(n).cast("bigint"), F.col(label).cast("bigint")
    sums = counts.groupBy(word).agg(F.count(F.lit(1)).alias("_df"), F.sum(x).alias("_x"), F.sum(x * x).alias("_xx"),
                                    F.sum(x * y).alias("_xy")).where(F.col("_df") >= min_df)
    mean = F.col("_x") / F.lit(float(rows))
    cov = F.col("_xy") / F.lit(float(rows)) - mean * F.lit(positives / rows if rows else 0.0)
    var = F.col("_xx") / F.lit(float(rows)) - mean * mean
    shrunk = F.when(cov > penalty, cov - penalty).when(cov < -penalty, cov + penalty).otherwise(F.lit(0.0))
    return sums.select(word, F.coalesce(F.try_divide(shrunk, var), F.lit(0.0)).alias("weight"))


def best_by(df: DataFrame, metric: str, tie_cols: list[str],
            descending: bool = True) -> DataFrame:
    """The one best row; ties go to the first row in ``tie_cols`` order
    (argmax semantics). A top-1, not a full sort."""
    order = F.desc(metric) if descending else F.asc(metric)
    return df.orderBy(order, *[F.asc(c) for c in tie_cols]).limit(1)


def top_bottom(df: DataFrame, weight: str, key: str, k: int) -> DataFrame:
    """The k lowest and k highest weights, tagged ``end`` = bottom / top and
    ``rank`` 1..k. Each side is a TakeOrdered (per-partition top-k merged),
    never a global sort."""
    bottom = (df.orderBy(F.asc(weight), F.asc(key)).limit(k)
              .withColumn("end", F.lit("bottom")))
    top = (df.orderBy(F.desc(weight), F.asc(key)).limit(k)
           .withColumn("end", F.lit("top")))
    both = bottom.unionByName(top)
    # rank inside each (tiny, k-row) side
    w_b = Window.partitionBy("end").orderBy(
        F.when(F.col("end") == "top", -F.col(weight)).otherwise(F.col(weight)),
        F.asc(key))
    return both.withColumn("rank", F.row_number().over(w_b))


ROWS_A_RANGE = 100_000


def in_ranges(df: DataFrame, order: list[Column], rows_per_range: int = ROWS_A_RANGE, col: str = "_range") -> DataFrame:
    """``df`` cut into ranges of ``order`` (distinct, all told): a landed table with ``col``, an array that
    orders the ranges, each of which holds at most twice ``rows_per_range`` rows.

    As many ranges as the rows need, cut at sampled values; ranges that sampling left too large are cut again until
    none is, so neither the number of ranges nor the skew of the values is bounded."""
    from opinio.sources.readers import land

    df = land(df, "unranged")
    n = df.count()
    if n <= rows_per_range:
        return df.withColumn(col, F.array(F.lit(0)))
    done, todo, many = None, df.withColumn(col, F.array().cast("array<int>")), n
    while many:
        parts = max(2, math.ceil(many / rows_per_range))
        cut = todo.repartitionByRange(parts, F.col(col), *order)
        cut = land(cut.withColumn(col, F.concat(col, F.array(F.spark_partition_id()))), "ranged")
        large = cut.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 2 * rows_per_range)
        large = land(large, "large-ranges")
        many = large.agg(F.sum("_n")).first()[0] or 0
        fine = cut.join(large.select(col), col, "left_anti") if many else cut
        done = fine if done is None else done.unionByName(fine)
        todo = cut.join(large.select(col), col, "left_semi") if many else None
    return done


def prefix_sums(df: DataFrame, order_col: str, sum_cols: list[str],
                by: list[str] | None = None, suffix: str = "_before",
                rows_per_range: int = ROWS_A_RANGE) -> DataFrame:
    """For every row, the sums of ``sum_cols`` over all rows (of the same
    ``by`` group) with a strictly smaller ``order_col``.

    Distributed: rows are cut into ranges of ``order_col`` (``in_ranges``: as many as the rows
    need), per-range totals (a row a range and group) are accumulated, and the rest is a window inside each range. No step
    puts a whole group into one task. ``order_col`` values should be distinct
    within a group (pre-aggregate first).
    """
    by = list(by or [])
    ranged = in_ranges(df, [F.col(c) for c in (order_col, *by)], rows_per_range)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias("_t_" + c) for c in sum_cols])
    w_tot = (Window.partitionBy(*by).orderBy("_range")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*by, "_range", *[
        F.coalesce(F.sum("_t_" + c).over(w_tot), F.lit(0)).alias("_o_" + c)
        for c in sum_cols])
    w_in = (Window.partitionBy(*by, "_range").orderBy(order_col)
            .rowsBetween(Window.unboundedPreceding, -1))
    return ranged.join(offsets, [*by, "_range"]).select(
        *df.columns,
        *[(F.col("_o_" + c) + F.coalesce(F.sum(c).over(w_in), F.lit(0))).alias(c + suffix) for c in sum_cols])


def ranks(df: DataFrame, order: list[Column], col: str, rows_per_range: int = ROWS_A_RANGE) -> DataFrame:
    """``df`` with ``col``, the place of each row (from 0) in ``order`` (distinct, all told): the rows of the
    ranges before, plus the place inside its range."""
    ranged = in_ranges(df, order, rows_per_range)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.join(offsets, "_range").select(*df.columns, (F.col("_o") + place - 1).alias(col))
