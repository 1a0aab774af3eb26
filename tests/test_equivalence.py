"""Relational forms equal the Spark ML stages; results do not depend on
partitioning; moments-based OLS equals LinearRegression."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from opinio.catalog import QUERIES, RUNS, STOP_WORDS, _filled_ratings
from opinio.functions.columns import letter_tokens, whitespace_tokens
from opinio.operators import text
from opinio.plans import metrics as M
from opinio.plans import regression as RG
from opinio.plans import views as V


def test_tokenizers_match_ml_stages(spark):
    docs = V.docs(spark, SF_SMALL)
    ws = text.ml_tokenizer("text", "ml_ws", "whitespace").transform(docs)
    ws = text.ml_tokenizer("text", "ml_lt", "letters").transform(ws)
    bad = ws.where((whitespace_tokens("text") != F.col("ml_ws")) |
                   (letter_tokens("text") != F.col("ml_lt"))).count()
    assert bad == 0


def test_relational_tfidf_matches_ml_pipeline(spark):
    docs = V.docs(spark, SF_SMALL)
    model = text.tfidf_estimator("text", list(STOP_WORDS)).fit(docs)
    vocab = text.fitted_vocabulary(model)
    ml = model.transform(docs).select("doc_id", vector_to_array("tfidf").alias("v"))
    ml_rows = {}
    for r in ml.collect():
        for i, x in enumerate(r.v):
            if x != 0.0:
                ml_rows[(r.doc_id, vocab[i])] = x
    t = text.tokenize(docs, "text", "words", "letters")
    t = text.remove_stop_words(t, "words", "filtered", STOP_WORDS)
    counts = text.term_counts(text.explode_tokens(t, ["doc_id"], "filtered"), "doc_id")
    via_expr = text.term_counts(text.explode_tokens(
        docs, ["doc_id"], text.without_stop_words(letter_tokens("text"), STOP_WORDS)),
        "doc_id")
    assert counts.exceptAll(via_expr).count() == 0 and via_expr.exceptAll(counts).count() == 0
    idf = text.idf_weights(text.vocabulary(counts), docs.count())
    rel = {(r.doc_id, r.word): r.tfidf for r in text.tfidf(counts, idf, "doc_id").collect()}
    # words with idf 0 vanish from the ML vectors; compare the rest
    assert {k for k, v in rel.items() if v != 0.0} == set(ml_rows)
    for k, v in ml_rows.items():
        assert rel[k] == pytest.approx(v, rel=1e-9)
    assert set(vocab) == {r.word for r in idf.collect()}


def test_moments_ols_matches_linear_regression(spark):
    f = _filled_ratings(spark, SF_MID).cache()
    rep = {r.run: r.mse for r in
           RG.subset_mse_report(spark, f, "label", RUNS).collect()}
    for run in (1, 4, 7, 11):
        feats, fit_on, score_on = RUNS[run - 1]
        model = RG.fit_ols(f.where(F.col("split") == fit_on), feats, "label")
        scored = model.transform(f.where(F.col("split") == score_on))
        assert M.mse(scored, "prediction", "label").first().mse == \
            pytest.approx(rep[run], rel=1e-9)
    coef = {(r.run, r.column): r.weight for r in
            RG.subset_coefficients(spark, f, "label", RUNS[7:8]).collect()}
    model = RG.fit_ols(f.where(F.col("split") == "train"), RUNS[7][0], "label")
    lr = model.stages[-1]
    for name, w in zip(RUNS[7][0], lr.coefficients.toArray()):
        assert coef[(1, name)] == pytest.approx(w, rel=1e-6)
    assert coef[(1, "intercept")] == pytest.approx(lr.intercept, rel=1e-6)
    f.unpersist()


def test_auc_matches_evaluator(spark):
    r = V.ratings_split(spark, SF_SMALL).where("split = 'train'")
    ours = M.area_under_roc(r, "o_totalprice", "label").first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="o_totalprice",
                                       labelCol="label", numBins=0)
    theirs = ev.evaluate(r.withColumn("label", F.col("label").cast("double")))
    assert ours == pytest.approx(theirs, rel=1e-12)


@pytest.mark.parametrize("name", [
    "lexicon_entity_sentiment", "hash_split", "pruned_vocabulary", "auc",
    "subset_mse_report", "entity_mean_2se", "tfidf", "top_bottom_words",
    "lexicon_accuracy", "busy_entities", "impute_mean",
])
def test_partitioning_does_not_change_results(spark, name):
    """Same answer with 1 and 7 shuffle partitions."""
    got = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()),
                              key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got[0] == got[1]


def test_hash_split_is_stable_under_repartition(spark):
    r = V.ratings(spark, SF_SMALL)
    from opinio.operators.split import hash_split
    a = sorted(hash_split(r.repartition(1), "l_orderkey").select("l_orderkey", "line", "split").collect())
    b = sorted(hash_split(r.repartition(7), "l_orderkey").select("l_orderkey", "line", "split").collect())
    assert a == b
    shares = {row.split: row.n for row in
              hash_split(V.ratings(spark, SF_MID), "l_orderkey").groupBy("split")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(shares.values())
    assert abs(shares["train"] / total - 0.6) < 0.03
    assert abs(shares["test"] / total - 0.1) < 0.03
