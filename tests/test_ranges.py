"""Ranges of bounded size: ranks, prefix sums and AUC on skewed values."""

import random

import pytest
from pyspark.sql import functions as F

from opinio.operators import text
from opinio.operators.aggregate import in_ranges, prefix_sums, ranks
from opinio.plans import metrics as M


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows within one millionth of the value range."""
    rnd = random.Random(8)
    rows = [(k, (0.5 + k * 1e-12) if k % 3 else rnd.random() * 1000, k % 7) for k in range(20_000)]
    return spark.createDataFrame(rows, "id long, x double, w long").repartition(5).cache(), rows


def test_every_range_is_bounded(spark, skewed):
    df, rows = skewed
    cut = in_ranges(df, [F.col("x")], rows_per_range=50).cache()
    sizes = [r[1] for r in cut.groupBy("_range").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 100 and len(sizes) >= 200
    spans = cut.groupBy("_range").agg(F.min("x").alias("a"), F.max("x").alias("b")).orderBy("_range").collect()
    assert all(p.b < q.a for p, q in zip(spans, spans[1:]))


def test_prefix_sums_and_ranks(spark, skewed):
    df, rows = skewed
    want, total = {}, 0
    for place, (k, _, w) in enumerate(sorted(rows, key=lambda r: r[1])):
        want[k] = place, total
        total += w
    for size in (70, 1_000_000):
        sums = {r.id: r.w_before for r in prefix_sums(df, "x", ["w"], rows_per_range=size).collect()}
        places = {r.id: r.place for r in ranks(df, [F.col("x")], "place", rows_per_range=size).collect()}
        assert {k: (places[k], sums[k]) for k in places} == want
    grouped = df.withColumn("g", F.col("id") % 2)
    got = {r.id: r.w_before for r in prefix_sums(grouped, "x", ["w"], by=["g"], rows_per_range=90).collect()}
    run = {0: 0, 1: 0}
    for k, _, w in sorted(rows, key=lambda r: r[1]):
        assert got[k] == run[k % 2]
        run[k % 2] += w


def test_auc_over_many_ranges(spark, skewed):
    df, rows = skewed
    scored = df.withColumn("y", (F.col("id") % 5 == 0).cast("int"))
    order = sorted(rows, key=lambda r: r[1])
    negatives = pairs = 0
    for k, _, _ in order:
        if k % 5:
            negatives += 1
        else:
            pairs += negatives
    auc = M.area_under_roc(scored, "x", "y", rows_per_range=40).first().auc
    assert auc == pytest.approx(pairs / negatives / (len(rows) - negatives), abs=1e-12)


def test_vocabulary_of_one_frequency_class(spark):
    """All words occur equally often: the class is cut by word."""
    counts = spark.range(6000).select(F.explode(F.sequence(F.lit(0), F.lit(5))).alias("doc"),
                                      F.format_string("w%05d", "id").alias("word"), F.lit(1).alias("n"))
    got = {r.word: r.term_index for r in text.vocabulary(counts, rows_per_range=100).collect()}
    assert got == {f"w{k:05d}": k for k in range(6000)}
    cut = text.vocabulary(counts, vocab_size=10, rows_per_range=100).select("word").collect()
    assert sorted(r.word for r in cut) == [f"w{k:05d}" for k in range(10)]


def test_no_rows(spark):
    none = spark.createDataFrame([], "x double, w long")
    assert prefix_sums(none, "x", ["w"]).count() == 0 and ranks(none, [F.col("x")], "p").count() == 0
