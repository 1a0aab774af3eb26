"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send the module's functions to executors by value, so that the package
    need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def worker_cache() -> dict:
    """Objects that stay with a Python worker from task to task."""
    name = "opinio_worker_cache"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def trim() -> None:
    """Give memory that finished work has freed back to the system (Python workers live on)."""
    import ctypes
    import gc

    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


ship(__name__)


BUCKETS_A_PARTITION = 2
MOST_BUCKETS = 100_000  # Spark's limit of a bucketed table


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, a folder of the warehouse serves in local mode (tests, notebooks); a cluster must name one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    return path or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


_recording: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the paths of the tables that ``land`` writes inside."""
    paths: list[str] = []
    _recording.append(paths)
    try:
        yield paths
    finally:
        _recording.remove(paths)


def remove_landed(spark: SparkSession, paths: list[str], reader: DataFrame) -> None:
    """Remove landed tables whose readers are done; those that ``reader`` scans stay."""
    files = reader.inputFiles() if paths else []
    for path in paths:
        if not any(path.rsplit("/", 1)[1] in f for f in files):
            there = spark._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and scan it from there:
    cuts the lineage and survives a lost executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/opinio-llm/{name}-{uuid.uuid4().hex}"
    for paths in _recording:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def land_in_buckets(df: DataFrame, name: str, key: str) -> DataFrame:
    """``land`` with the rows in files by the hash of ``key``, so that grouping or cogrouping by it reads the files where they
    lie and shuffles the other side only. Nothing is shuffled to write them: this is for a key whose rows lie in one partition
    already (else the files are many). The number of buckets grows with the input's partitions."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/opinio-llm/{name}-{uuid.uuid4().hex}"
    for paths in _recording:
        paths.append(path)
    kept = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
    buckets = min(MOST_BUCKETS, max(width(spark), BUCKETS_A_PARTITION * df.rdd.getNumPartitions()))
    df.write.bucketBy(buckets, key).format("parquet").option("path", path).saveAsTable(kept)
    return spark.table(kept)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: Column) -> Column:
    """128-bit digest that stands for a text (NULL counts as empty)."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def width(spark: SparkSession, floor: int = 1) -> int:
    return max(floor, int(spark.conf.get("spark.sql.shuffle.partitions")))


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, vectorised over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bundled(df: DataFrame, *outside: str) -> Column:
    """All columns of ``df`` but ``outside`` as one struct, so that no name can clash with those an operator uses."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns if c not in outside]) if set(df.columns) - set(outside) \
        else F.struct(F.lit(None).cast("int").alias("none"))


def in_blocks(df: DataFrame, group: str, node: str, block_rows: int) -> DataFrame:
    """Cut groups larger than ``block_rows`` into blocks and deal every pair of
    blocks of a group to a task of its own.

    Adds ``blk`` (the row's block), ``bi`` <= ``bj`` (the pair of blocks): group
    by (``group``, ``bi``, ``bj``) and compare rows of block ``bi`` with rows of
    block ``bj``; every pair of rows of a group meets exactly once, whatever
    the group's size, and no task holds more than two blocks."""
    sizes = (df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
             .select(group, F.ceil(F.col("_n") / F.lit(block_rows)).cast("int").alias("_blocks")))
    out = (df.join(sizes, group)
           .withColumn("blk", F.pmod(F.xxhash64(node), F.col("_blocks").cast("bigint")).cast("int"))
           .withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))
    return (out.withColumn("bi", F.least("blk", "_o")).withColumn("bj", F.greatest("blk", "_o"))
            .drop("_o", "_blocks"))
