"""Tables landed in buckets of a key: same rows, and no shuffle by that key afterwards."""

import io
from collections import Counter
from contextlib import redirect_stdout

from conftest import SF_SMALL
from pyspark.sql import functions as F

from opinio.catalog import _filled_ratings
from opinio.plans import views as V
from opinio.sources.readers import land_bucketed


def _plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _rows(df) -> Counter:
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def test_bucketed_view_is_the_view_without_shuffles(spark):
    view = V.ratings(spark, SF_SMALL, bucketed=True)
    assert _rows(view) == _rows(V.ratings(spark, SF_SMALL))
    plan = _plan(view.groupBy("l_orderkey").agg(F.avg("l_quantity")))
    assert "SortMergeJoin" in plan and "hashpartitioning" not in plan


def test_landed_ratings_are_read_without_exchange(spark):
    filled = _filled_ratings(spark, SF_SMALL)
    assert "Exchange" not in _plan(filled)
    landed = V.landed_ratings(spark, SF_SMALL)
    assert _rows(landed) == _rows(V.ratings_split(spark, SF_SMALL))
    means = _plan(landed.where("split = 'train'").agg(F.avg("l_discount"), F.avg("l_tax")))
    assert means.count("Exchange") == 1 and "SinglePartition" in means  # partial sums only
    assert "Exchange" not in _plan(landed.groupBy("l_orderkey").count())


def test_files_are_buckets_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 101).alias("k"), "id").repartition(3)
    out = land_bucketed(df, "few", "k", buckets=5)
    assert _rows(out) == _rows(df)
    files = {}
    for r in out.select("k", "id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("m")).orderBy("m").collect():
        files.setdefault(r.f, []).append(r.k)
    assert len(files) == 5 and all(ks == sorted(ks) for ks in files.values())
    assert sum(len(set(ks)) for ks in files.values()) == 101  # a key is in one file


def test_empty_table_and_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert _rows(land_bucketed(df, "nulls", "k", 2)) == _rows(df)
    assert land_bucketed(df.limit(0), "none", "k", 2).count() == 0
