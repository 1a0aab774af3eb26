"""Sources (S1-S5) and sinks.

Review CSV files hold free text with embedded newlines and doubled quotes,
so they are read with ``multiLine`` and ``escape='"'`` and an explicit
all-string schema (no inference pass, header row not taken as data). Spark's
reader takes one task per such file; ``csv_split.read_split_csv`` reads byte ranges.
Large inputs are landed once to
parquet (``land_csv``) and every later job reads the columnar copy with
column pruning and predicate pushdown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.operators.partition import spread
from opinio.specs import all_string_schema


def read_review_csv(spark: SparkSession, path: str,
                    schema: T.StructType | list[str] | None = None,
                    header: bool = True) -> DataFrame:
    """Read review CSV files: quoted multi-line fields, ``""`` escapes."""
    reader = (spark.read.option("header", header)
              .option("multiLine", True)
              .option("escape", '"')
              .option("quote", '"')
              .option("mode", "PERMISSIVE"))
    if isinstance(schema, list):
        schema = all_string_schema(schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, header: bool = True,
              quote_all: bool = True, single_file: bool = False) -> str:
    """CSV sink. Parallel part files by default; ``single_file`` only for
    small, bounded tables (a report)."""
    out = df.coalesce(1) if single_file else df
    (out.write.mode("overwrite")
     .option("header", header)
     .option("quoteAll", quote_all)
     .option("escape", '"')
     .csv(path))
    return path


def land_csv(spark: SparkSession, csv_path: str, parquet_path: str,
             schema: T.StructType | list[str], header: bool = True) -> DataFrame:
    """Read multi-line CSV once, in byte ranges, write parquet, return the parquet scan."""
    from opinio.sources.csv_split import read_split_csv

    read_split_csv(spark, csv_path, schema, header).write.mode(
        "overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """Sentiment lexicon ``(word, sentiment)`` from parquet."""
    return spark.read.parquet(path).select("word", "sentiment")


def corpus_count(spark: SparkSession, path: str) -> DataFrame:
    """Row count of a parquet corpus as a one-row DataFrame."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"))


def read_word_list(spark: SparkSession, path: str,
                   col: str = "word") -> DataFrame:
    """Whitespace-separated words from text files: one row per word, in
    parallel over lines (the list is never built on the driver)."""
    lines = spark.read.text(path)
    words = lines.select(F.explode(F.split(F.col("value"), r"\s+")).alias(col))
    return words.where(F.col(col) != "")


def load_stop_words(spark: SparkSession, path: str | None = None) -> list[str]:
    """Stop words for ``StopWordsRemover``: from a word-list file when given,
    else Spark's bundled English list. A bounded parameter list."""
    if path is None:
        from pyspark.ml.feature import StopWordsRemover
        return list(StopWordsRemover.loadDefaultStopWords("english"))
    return [r[0] for r in read_word_list(spark, path).distinct().collect()]


def read_parquet(spark: SparkSession, path: str, spread_out: bool = True,
                 key: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return spread(df, key=key) if spread_out else df


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a derived table once to the shared checkpoint folder and return
    a scan of the written copy: later jobs (several model fits, reports)
    read columnar parquet with pruning instead of recomputing joins, and an
    executor loss costs a re-read, not a recomputation."""
    from opinio.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def land_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """``land`` with the rows hashed by ``key`` into ``buckets`` files (default: the session's shuffle partitions), sorted
    inside each: one shuffle now, and none in later joins and aggregations by ``key`` with tables of as many
    buckets (a merge join still sorts each file, which is in order already). A key's rows lie in one file, so
    this is for keys of few rows each, such as an order; rows with a NULL key share a file.

    The table's files lie in the shared folder (or ``path``); its name is of this session's catalog."""
    import uuid

    from opinio.session import scratch_path

    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", path or scratch_path(spark, name)).saveAsTable(table))
    return spark.table(table)


def land_vectors(df: DataFrame, col: str, name: str = "vectors") -> DataFrame:
    """``land`` for a column holding the parts of ML vectors (type, size, indices, values): read back as vectors."""
    from pyspark.ml.linalg import VectorUDT

    from opinio.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name == col else f.dataType) for f in df.schema])
    return df.sparkSession.read.schema(schema).parquet(path)
