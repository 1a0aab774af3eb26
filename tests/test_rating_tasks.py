"""The joins behind the ratings are dealt by their rows: what a task sorts does not grow with the table."""

from collections import Counter

from opinio.operators import partition
from opinio.plans import views as V
from opinio.session import scratch_path


def _tables(spark):
    """Repeated and NULL keys on every side."""
    d = scratch_path(spark, "few-tables")
    li = [(k % 40 if k % 9 else None, k % 7 if k % 11 else None, k % 3, k % 4, 1.0 + k, 2.0, 0.0, 0.1, "RAN"[k % 3]) for k in range(300)]
    spark.createDataFrame(li, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                              "l_extendedprice double, l_discount double, l_tax double, l_returnflag string").write.parquet(f"{d}/lineitem.parquet")
    orders = [(k % 35, float(k)) for k in range(50)] + [(None, 1.0)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_totalprice double").write.parquet(f"{d}/orders.parquet")
    spark.createDataFrame([(0, 1, 1.0), (1, 2, 2.0), (1, 3, 3.0), (4, 5, 6.0), (None, 1, 1.0)],
                          "p_partkey bigint, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    return d


def test_tasks_grow_with_the_rows(spark, monkeypatch):
    d = _tables(spark)
    rows = lambda df: Counter(map(tuple, df.collect()))
    views = (lambda: V.ratings(spark, d), lambda: V.ratings(spark, d, labelled_only=False), lambda: V.ratings(spark, d, bucketed=True),
             lambda: V.landed_ratings(spark, d))
    plain = [rows(v()) for v in views]
    monkeypatch.setattr(partition, "LEAST_DEALT", 10)
    monkeypatch.setattr(partition, "ROWS_A_JOIN_TASK", 20)
    for most in (V.MOST_PARTS_SENT, 2):  # parts broadcast, and hashed
        monkeypatch.setattr(V, "MOST_PARTS_SENT", most)
        assert [rows(v()) for v in views] == plain and all(plain)
    assert V.rating_tasks(spark, d) == 15
    plan = V.ratings(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 15), REPARTITION_BY_NUM") == 2
    landed = V.landed_ratings(spark, d)._jdf.queryExecution().executedPlan().toString()
    assert "out of 15" in landed or "Bucketed" in landed
