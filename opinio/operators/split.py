"""Train / validation / test splits."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.columns import hash_bucket

SPLITS = ("train", "validation", "test")
SPLIT_PARTITIONS = 64


def split_label(key_col: str, weights=(60, 30, 10), names=SPLITS,
                buckets: int = 100):
    """Column naming each row's split from the md5 bucket of its key.

    Reproducible: depends only on the key, not on partitioning, task order
    or retries, so it survives executor loss and re-reads."""
    if sum(weights) != buckets:
        raise ValueError("weights must add up to the bucket count")
    # a NULL key has no bucket: silently sending it to one split would be wrong
    key = F.coalesce(F.col(key_col).cast("string"), F.raise_error(F.lit(f"split key {key_col} is NULL")).cast("string"))
    # one lookup by bucket, so that the digest is worked out once a row
    named = F.array(*[F.lit(n) for w, n in zip(weights, names) for _ in range(w)])
    return F.get(named, hash_bucket(key, buckets))


def hash_split(df: DataFrame, key_col: str, weights=(60, 30, 10),
               names=SPLITS, col: str = "split") -> DataFrame:
    """Tag every row with its split (one pass; filter per split later)."""
    return df.withColumn(col, split_label(key_col, weights, names))


def random_split(df: DataFrame, weights=(0.6, 0.3, 0.1), seed: int = 0,
                 names=SPLITS, col: str = "split") -> DataFrame:
    """``randomSplit`` with the parts tagged and unioned back (R1 parity).
    The rows are first dealt by all their columns to ``SPLIT_PARTITIONS``, so
    the parts do not depend on cores or on the input's partitioning."""
    # randomSplit evaluates its input once per part; persisted input keeps
    # the parts disjoint and complete even if a recomputation would order
    # rows differently
    df = df.repartition(SPLIT_PARTITIONS, *df.columns).persist(StorageLevel.MEMORY_AND_DISK)
    parts = df.randomSplit(list(weights), seed=seed)
    tagged = [p.withColumn(col, F.lit(n)) for p, n in zip(parts, names)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t)
    return out


def split_counts(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split in one aggregation instead of one count per split."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
