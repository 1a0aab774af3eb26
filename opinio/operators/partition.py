"""Partitioning: enough tasks to use every core after a scan, and a fixed,
reproducible layout for iterative model fitting."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

PLAIN_TYPES = {"string", "long", "integer", "double", "float", "boolean", "date", "timestamp"}


def spread(df: DataFrame, min_partitions: int | None = None,
           key: str | None = None) -> DataFrame:
    """Make sure CPU-heavy work after a scan is not stuck in a few tasks.

    A scan yields one partition per file split / row group; a handful of
    large unsplittable files would leave most cores idle during
    tokenising. Only when the scan has fewer partitions than the cluster's
    default parallelism is it redistributed -- by hash of a high-cardinality
    ``key`` when given (deterministic, no sort), else round-robin; on a
    large input with thousands of splits this is a no-op and adds no
    shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    current = df.rdd.getNumPartitions()
    if current < target:
        return df.repartition(target, key) if key else df.repartition(target)
    return df


ROWS_A_JOIN_TASK, LEAST_DEALT = 500_000, 2_000_000


def join_tasks(spark, rows: int) -> int | None:
    """Tasks of a shuffle join that reads ``rows`` rows, so that none sorts more than about ROWS_A_JOIN_TASK of them; not fewer
    than the session's number (the planner would deal the rows again). None (that number, which AQE lowers) where
    there are at most LEAST_DEALT rows."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-rows // ROWS_A_JOIN_TASK)) if rows > LEAST_DEALT else None


ROWS_A_FIT_PARTITION = 100_000


def fit_partitions(spark, rows: int = 0) -> int:
    """Partitions of a model's training input: one for every ROWS_A_FIT_PARTITION
    rows, at least ``spark.opinio.fit.partitions`` (default 4). A function of the
    rows, not of cores, because bagging follows partitions: the same rows
    give the same model on any cluster."""
    least = int(spark.conf.get("spark.opinio.fit.partitions", "4"))
    return max(least, -(-rows // ROWS_A_FIT_PARTITION))


def persist_for_iterations(df: DataFrame, keys: list[str] | None = None,
                           level: StorageLevel = StorageLevel.MEMORY_AND_DISK
                           ) -> DataFrame:
    """Persist a model's training input, dealt by ``keys`` (default: all
    plain columns) to ``fit_partitions`` and ordered inside, so that a seeded
    fit depends on the rows alone. The caller unpersists."""
    keys = keys or [f.name for f in df.schema.fields
                    if f.dataType.typeName() in PLAIN_TYPES]
    n = fit_partitions(df.sparkSession, df.count())
    cached = df.repartition(n, *keys).sortWithinPartitions(*keys).persist(level)
    cached.count()
    return cached
