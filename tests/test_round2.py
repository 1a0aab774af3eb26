"""Behaviour that must not depend on sizes, cores or installed files."""

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from opinio.functions.stopwords import bundled_stop_words
from opinio.operators import split, text
from opinio.operators.partition import persist_for_iterations
from opinio.plans import lexicon as lx
from opinio.plans import metrics as M


def test_stop_words_equal_sparks_list(spark):
    assert list(bundled_stop_words()) == StopWordsRemover.loadDefaultStopWords("english")


def test_registry_reads_no_file_at_import(monkeypatch):
    import glob
    import importlib
    import sys

    monkeypatch.setattr(glob, "glob", lambda *a, **k: [])
    saved = {m: sys.modules.pop(m) for m in list(sys.modules) if m.startswith("opinio") and ".llm" not in m}
    try:
        catalog = importlib.import_module("opinio.catalog")
        assert len(catalog.QUERIES) >= 62 and len(catalog.ORACLE) >= 46
    finally:
        for m in [m for m in sys.modules if m.startswith("opinio") and ".llm" not in m]:
            del sys.modules[m]
        sys.modules.update(saved)


def test_null_score_counts_alike_in_both_plans(spark):
    df = spark.createDataFrame([("a", "good odd good")], "e string, t string")
    lex = spark.createDataFrame([("good", 1.0), ("odd", None)], "word string, sentiment double")
    got = [lx.entity_sentiment(df, "e", "t", lex, cap).first().avg_sentiment for cap in (100, 0)]
    assert got == [1.0, 1.0]


def test_random_split_ignores_partitioning(spark):
    df = spark.range(2000).withColumn("x", F.col("id") % 7)
    a = {tuple(r) for r in split.random_split(df.repartition(3)).collect()}
    b = {tuple(r) for r in split.random_split(df.repartition(11, "x")).collect()}
    assert a == b and len(a) == 2000


def test_null_split_key_is_an_error(spark):
    df = spark.createDataFrame([(None,)], "k string")
    with pytest.raises(Exception, match="split key"):
        split.hash_split(df, "k").collect()


def test_auc_of_huge_counts(spark):
    one = spark.range(1).select(F.lit(4_000_000_000).alias("pos"), F.lit(4_000_000_000).alias("neg"))
    assert one.select((F.col("pos").cast("double") * F.col("neg").cast("double"))).first()[0] == 1.6e19
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    assert M.area_under_roc(df, "s", "y").first().auc == 0.75


def test_model_input_layout_is_fixed(spark):
    df = spark.range(1000).withColumn("x", F.col("id") * 2.0)
    lay = lambda d: persist_for_iterations(d).withColumn("p", F.spark_partition_id())
    a = {(r.id, r.p) for r in lay(df.repartition(2)).collect()}
    b = {(r.id, r.p) for r in lay(df.repartition(9)).collect()}
    assert a == b and len({p for _, p in a}) > 1


def test_model_input_layout_grows_with_the_rows(spark, monkeypatch):
    from opinio.operators import partition

    assert partition.fit_partitions(spark, 400_000) == 4 and partition.fit_partitions(spark, 10**9) == 10_000
    monkeypatch.setattr(partition, "ROWS_A_FIT_PARTITION", 100)
    df = spark.range(1000).withColumn("x", F.col("id") * 2.0)
    parts = [persist_for_iterations(df.repartition(k)).rdd.getNumPartitions() for k in (2, 9)]
    assert parts == [10, 10]


def test_vocabulary_has_no_cap_unless_asked(spark):
    rows = [(d, f"w{k:04d}", 1 + (k % 3)) for d in range(5) for k in range(300)]
    counts = spark.createDataFrame(rows, "doc long, word string, n long")
    full = text.vocabulary(counts)
    assert full.count() == 300
    order = [r.word for r in full.orderBy("term_index").collect()]
    assert order == sorted(order, key=lambda w: (-(1 + int(w[1:]) % 3), w))
    assert text.vocabulary(counts, vocab_size=7).count() == 7


def test_whole_cell_value(spark):
    from opinio.catalog import _cell

    df = spark.createDataFrame([(1, '{"k": 123}'), (5, '{"k": 69}')], "event_id long, props string")
    assert [r[0] for r in df.select(_cell()).collect()] == ["123", "69}"]
