"""Projections, casts, filters and missing values."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.ml.feature import Imputer, ImputerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.columns import label_int, lenient_double
from opinio.operators.joins import semi_join_checked


def rename_positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Give the columns of a header-less read their names, by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def cast_lenient(df: DataFrame, cols: Iterable[str], suffix: str = "f",
                 drop_source: bool = True) -> DataFrame:
    """Add ``<col><suffix>`` = lenient double of each column, in one
    projection; optionally drop the string originals."""
    cols = list(cols)
    out = df.withColumns({c + suffix: lenient_double(c) for c in cols})
    return out.drop(*cols) if drop_source else out


def cast_label(df: DataFrame, col: str, out: str, as_double: bool = False,
               drop_source: bool = True) -> DataFrame:
    """0/1 label from text: via double, so ``"1.0"`` -> 1; junk -> NULL."""
    expr = label_int(col)
    if as_double:
        expr = expr.cast("double")
    res = df.withColumn(out, expr)
    return res.drop(col) if drop_source and col != out else res


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*list(cols))


def labelled_only(df: DataFrame, label: str, values=(0, 1)) -> DataFrame:
    """Keep rows whose label is one of ``values``; NULL and other labels go.
    One scan, instead of a union of one filter per value."""
    return df.where(F.col(label).isin(*values))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by column name of any number of frames (bag semantics)."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def union_by_label(df: DataFrame, label: str, values=(1, 0)) -> DataFrame:
    """The reference formulation: one filter per label value, unioned."""
    return union_all(*[df.where(F.col(label) == v) for v in values])


def drop_missing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def non_null_count(df: DataFrame, col: str, alias: str = "n") -> DataFrame:
    return df.where(F.col(col).isNotNull()).agg(F.count(F.lit(1)).alias(alias))


def fill_constants(df: DataFrame, constants: Mapping[str, float]) -> DataFrame:
    """Replace NULL and NaN in each column by its given constant."""
    return df.na.fill(dict(constants))


def fit_mean_imputer(df: DataFrame, cols: list[str],
                     strategy: str = "mean") -> ImputerModel:
    """Column means (ignoring NULL/NaN) from ``df`` -- fit on training rows
    only, so the fill carries no information from validation/test."""
    return Imputer(inputCols=cols, outputCols=cols, strategy=strategy).fit(df)


def impute_mean(fit_df: DataFrame, apply_df: DataFrame,
                cols: list[str]) -> DataFrame:
    return fit_mean_imputer(fit_df, cols).transform(apply_df)


def entity_subset(df: DataFrame, entity: str,
                  entities: Iterable[str] | DataFrame,
                  max_broadcast_rows: int = 1_000_000) -> DataFrame:
    """Rows whose entity is in a list (an InSet filter) or in the entity
    column of another DataFrame (a left-semi join, broadcast only when that
    side is checked to be small)."""
    if isinstance(entities, DataFrame):
        return semi_join_checked(df, entities.select(entity), entity,
                                 max_broadcast_rows)
    return df.where(F.col(entity).isin(list(entities)))


def project_where(df: DataFrame, cols: list[str | Column],
                  cond: Column | None = None) -> DataFrame:
    out = df.select(*cols)
    return out.where(cond) if cond is not None else out
