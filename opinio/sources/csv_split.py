"""Multi-line CSV read in many tasks.

A quoted field may hold line ends, so a byte range of a file cannot tell where its first
record starts: that depends on whether the quotes before it are balanced. Three scans of
physical lines, which Spark cuts into byte ranges by itself:

1. Every range counts its lines with an odd number of quotes, and notes the first and the last
   of them. A prefix sum over the ranges of each file (a row a range) tells which ranges
   start inside a field, and which range holds the beginning of a record that crosses a cut.
2. Lines that belong to such a record (up to the first odd line of a range that starts inside a
   field; from the last odd line of a range that ends inside one) are grouped by its beginning and put together.
3. All other lines form whole records inside their range; a task puts lines together as it reads them.

Records are then parsed by ``from_csv`` with the options of ``read_review_csv``.

Quotes must be balanced as writers of quoted CSV leave them (a quote inside a field doubled); a file whose
quotes are not balanced raises an error. Line ends inside fields stay as they are; a record may end in LF or CRLF. Empty
lines are skipped. A record is held by one task, whatever its length; so are, in
the prefix sum, the ranges of one file (some numbers a range).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.operators.joins import has_at_most

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

QUOTE = '"'
MOST_BROADCAST_RANGES = 1_000_000  # some 30 MB; more ranges are joined by a shuffle


def physical_lines(spark: SparkSession, path) -> DataFrame:
    """(value, file, start, line, odd): ``start`` is the first byte of the range, ``line`` rises inside a
    range, ``odd`` tells whether the line has an odd number of quotes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(QUOTE), F.lit("")))
    return lines.select("value", F.xxhash64("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("start"),
                        F.monotonically_increasing_id().alias("line"), (quotes % 2 == 1).alias("odd"))


def range_table(lines: DataFrame) -> DataFrame:
    """One row a range: ``inside`` (it starts inside a field), ``open`` (it ends inside one), ``owner``
    (start of the range where the record that reaches into this one begins), ``first`` line, and the
    first and last odd lines."""
    counted = lines.groupBy("file", "start").agg(
        F.sum(F.col("odd").cast("bigint")).alias("n"), F.min("line").alias("first"),
        F.min(F.when(F.col("odd"), F.col("line"))).alias("first_odd"), F.max(F.when(F.col("odd"), F.col("line"))).alias("last_odd"))
    file = Window.partitionBy("file")
    before = file.orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    out = counted.withColumn("inside", F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1)
    out = out.withColumn("inside", F.when(F.sum("n").over(file) % 2 == 1, F.raise_error(F.lit("quotes are not balanced")))
                         .otherwise(F.col("inside")))
    out = out.withColumn("open", F.col("inside") != (F.col("n") % 2 == 1))
    # a record that is open at the end begins here, unless the range lies wholly inside one
    begins = F.when(F.col("open") & (~F.col("inside") | (F.col("n") > 0)), F.col("start"))
    return out.withColumn("owner", F.last(begins, ignorenulls=True).over(before)).drop("n")


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of lines that come range by range, in order; balanced at every end of a range."""
    held: list[str] = []
    for batch in batches:
        values = batch["value"].to_pylist()
        odd = batch["odd"].to_numpy(zero_copy_only=False)
        ends = np.flatnonzero((np.cumsum(odd) + (len(held) > 0)) % 2 == 0) + 1
        out, at = [], 0
        for end in ends.tolist():
            lines = held + values[at:end]
            out.append(lines[0] if len(lines) == 1 else "\n".join(lines))
            held, at = [], end
        held += values[at:]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])


def read_records(spark: SparkSession, path, header: bool = True) -> DataFrame:
    """(record): every record of the files, as text; without the first of each file where there is a ``header``."""
    from opinio.sources.readers import land

    lines = physical_lines(spark, path)
    ranges = land(range_table(lines), "csv-ranges")
    few = has_at_most(ranges, MOST_BROADCAST_RANGES)
    known = ranges.withColumnsRenamed({"file": "r_file", "start": "r_start"})
    joined = lines.join(F.broadcast(known) if few else known, (F.col("file") == F.col("r_file")) & (F.col("start") == F.col("r_start")))
    line = F.col("line")
    head = F.col("inside") & (F.col("first_odd").isNull() | (line <= F.col("first_odd")))
    tail = F.col("open") & F.col("last_odd").isNotNull() & (line >= F.col("last_odd"))
    # a header of one line ends where it starts; one that crosses a cut is not supported
    if header:
        joined = joined.where(~((F.col("start") == 0) & (line == F.col("first")) & ~F.col("odd")))
    own = joined.where(~(head | tail))
    if not few:  # a join by shuffle leaves no order
        own = own.sortWithinPartitions("file", "start", "line")
    whole = own.select("value", "odd").mapInArrow(_whole_records, "record string")
    crossing = (joined.where(head | tail)
                .select("file", F.when(tail, F.col("start")).otherwise(F.col("owner")).alias("owner"), "start", "line", "value")
                .groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("parts"))
                .select(F.array_join(F.col("parts")["value"], "\n").alias("record")))
    record = F.regexp_replace("record", "^﻿|\r$", "")
    return whole.union(crossing).select(record.alias("record")).where("record != ''")


def read_split_csv(spark: SparkSession, path, schema: T.StructType | list[str], header: bool = True) -> DataFrame:
    """As ``read_review_csv`` with a schema, but a file is read by as many tasks as it has byte ranges
    (``spark.sql.files.maxPartitionBytes``)."""
    from opinio.specs import all_string_schema

    if isinstance(schema, list):
        schema = all_string_schema(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv("record", ddl, {"escape": QUOTE, "quote": QUOTE, "mode": "PERMISSIVE"})
    return read_records(spark, path, header).select(parsed.alias("r")).select("r.*")


__all__ = ["physical_lines", "range_table", "read_records", "read_split_csv"]
