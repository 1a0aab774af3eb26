"""One entity holding a third of all rows: results stay exact and the hot
group is combined map-side (partial aggregates), not gathered in one task."""

import io
import random
from contextlib import redirect_stdout

import pytest

from opinio.operators import aggregate as agg
from opinio.plans import lexicon as lx
from opinio.plans import metrics as M


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    words = ["good", "bad", "fine", "poor", "okay", "table", "chair"]
    rows = []
    for i in range(3000):
        entity = "hot" if i % 3 == 0 else f"e{i % 97}"
        text = " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 12)))
        rows.append((i, entity, text, float(rnd.random() < 0.4), rnd.random()))
    df = spark.createDataFrame(rows, "id long, e string, t string, y double, s double")
    return rows, df.repartition(6)


def _explain(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_hot_entity_mean_and_error(spark, skewed):
    rows, df = skewed
    rep = agg.mean_with_error(df, "e", "y", count_alias="n")
    assert "partial_avg" in _explain(rep)
    hot = [r for r in rep.collect() if r.e == "hot"][0]
    ys = [y for _, e, _, y, _ in rows if e == "hot"]
    mean = sum(ys) / len(ys)
    sd = (sum((y - mean) ** 2 for y in ys) / (len(ys) - 1)) ** 0.5
    assert hot.n == 1000
    assert hot.prediction == pytest.approx(mean)
    assert hot.err == pytest.approx(2 * sd / len(ys) ** 0.5)


@pytest.mark.parametrize("max_rows", [10, 0])
def test_hot_entity_lexicon(spark, skewed, max_rows):
    rows, df = skewed
    lex = spark.createDataFrame([("good", 1), ("fine", 1), ("okay", 1), ("bad", -1),
                                 ("poor", -1)], "word string, sentiment int")
    got = {r.e: r.avg_sentiment for r in
           lx.entity_sentiment(df, "e", "t", lex, max_rows).collect()}
    score = {"good": 1, "fine": 1, "okay": 1, "bad": -1, "poor": -1}
    hot = [score[w] for _, e, t, _, _ in rows if e == "hot" for w in t.split() if w in score]
    assert got["hot"] == pytest.approx(sum(hot) / len(hot))


def test_hot_score_value_auc(spark, skewed):
    """A third of all rows share one score value; AUC stays exact."""
    rows, df = skewed
    from pyspark.sql import functions as F
    tied = df.withColumn("s", F.when(F.col("e") == "hot", F.lit(0.5)).otherwise(F.col("s")))
    data = [(0.5 if e == "hot" else s, y) for _, e, _, y, s in rows]
    pos = [s for s, y in data if y == 1.0]
    neg = sorted(s for s, y in data if y == 0.0)
    import bisect
    area = sum(bisect.bisect_left(neg, p) + 0.5 * (bisect.bisect_right(neg, p) - bisect.bisect_left(neg, p))
               for p in pos)
    assert M.area_under_roc(tied, "s", "y").first().auc == pytest.approx(area / (len(pos) * len(neg)))
