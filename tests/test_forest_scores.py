"""A node table scores batches of rows; no expression is evaluated tree by tree for single rows."""

from opinio.plans.classify import forest_scores

NODES = "tree int, node int, depth int, feature string, threshold double, left_child int, right_child int, votes array<double>"


def test_batches_walk_down_all_trees(spark):
    nodes = spark.createDataFrame([
        (0, 0, 0, "b", 2.0, 1, 2, [4.0, 4.0]), (0, 1, 1, None, None, None, None, [3.0, 1.0]),
        (0, 2, 1, "a", 0.5, 3, 4, [1.0, 3.0]), (0, 3, 2, None, None, None, None, [1.0, 0.0]),
        (0, 4, 2, None, None, None, None, [0.0, 3.0]), (1, 0, 0, None, None, None, None, [1.0, 1.0])], NODES)
    rows = [(0, 0.5, 2.0), (1, 0.5, 2.5), (2, 0.6, 2.5), (3, None, 9.0), (4, 0.0, None), (5, float("nan"), float("nan"))]
    out = forest_scores(spark.createDataFrame(rows, "id int, a double, b double"), nodes, ["a", "b"])
    got = {r.id: (r.forest_score, r.forest_prediction) for r in out.collect()}
    assert got == {0: (0.375, 0.0), 1: (0.25, 0.0), 2: (0.75, 1.0), 3: (0.75, 1.0), 4: (0.25, 0.0), 5: (0.75, 1.0)}
    assert "lambdafunction" not in out._jdf.queryExecution().executedPlan().toString()
