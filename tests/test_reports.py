"""The composed analyses run end to end on the synthetic stand-ins."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from opinio.catalog import STOP_WORDS, _filled_ratings
from opinio.plans import views as V
from opinio.plans.reports import rating_models, text_sentiment


def test_rating_models(spark):
    out = rating_models(spark, _filled_ratings(spark, SF_SMALL), V.RATINGS)
    imp = out["forest_importances"].collect()
    assert len(imp) == 7 and abs(sum(r.weight for r in imp) - 1.0) < 1e-9
    aucs = {r.split: r.auc for r in out["logreg_auc"].collect()}
    assert set(aucs) == {"train", "validation", "test"}
    assert all(0.0 <= a <= 1.0 for a in aucs.values())


def test_text_sentiment(spark):
    out = text_sentiment(spark, V.reviews(spark, SF_SMALL), V.REVIEWS,
                         V.lexicon(spark, SF_SMALL), list(STOP_WORDS),
                         busy_threshold=1)
    assert out["grid"].count() == 9
    assert 0.0 <= out["lexicon_accuracy"].first().accuracy <= 1.0
    n = V.reviews(spark, SF_SMALL).count()
    assert out["scored"].count() == n
    rep = out["entity_report"].collect()
    assert rep and all(r.review_count > 1 for r in rep)
    assert out["word_weights"].where(F.col("weight").isNull()).count() == 0
