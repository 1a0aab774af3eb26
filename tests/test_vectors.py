"""Sparse TF-IDF vectors assembled from the tall table, against the ML stages word by word."""

import pytest
from conftest import SF_SMALL
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from opinio.catalog import STOP_WORDS
from opinio.operators.split import hash_split
from opinio.operators.text import fitted_vocabulary, tfidf_estimator
from opinio.plans import textmodels as TM
from opinio.plans import views as V


@pytest.mark.parametrize("split", [None, "train"])
def test_equal_the_stages_by_word(spark, split):
    docs = hash_split(V.docs(spark, SF_SMALL).where("text is not null"), "doc_id").select("doc_id", "text", "split").cache()
    keep = None if split is None else F.col("split") == split
    model = tfidf_estimator("text", list(STOP_WORDS)).fit(docs if keep is None else docs.where(keep))
    known = fitted_vocabulary(model)
    want = {r.doc_id: {known[i]: v for i, v in zip(r.tfidf.indices, r.tfidf.values)} for r in model.transform(docs).collect()}
    terms, vectors = TM.tfidf_vectors(docs, "doc_id", "text", list(STOP_WORDS), fit_filter=keep)
    words = {r.term_index: r.word for r in terms.collect()}
    assert sorted(words) == list(range(len(known))) and set(words.values()) == set(known)
    got = {}
    for r in vectors.collect():
        assert isinstance(r.tfidf, SparseVector) and r.tfidf.size == len(known)
        assert list(r.tfidf.indices) == sorted(set(r.tfidf.indices))
        got[r.doc_id] = {words[i]: v for i, v in zip(r.tfidf.indices, r.tfidf.values)}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k])
    docs.unpersist()


def test_no_words_and_no_rows(spark):
    rows = [(1, "alpha beta beta"), (2, ""), (3, "12 34"), (4, None), (5, "gamma"), (6, "alpha the")]
    df = spark.createDataFrame(rows, "id long, t string")
    terms, vectors = TM.tfidf_vectors(df, "id", "t", ["the"], min_df=2)
    assert [(r.word, r.term_index) for r in terms.collect()] == [("alpha", 0)]
    got = {r.id: (r.tfidf.size, list(r.tfidf.indices)) for r in vectors.collect()}
    assert got == {1: (1, [0]), 2: (1, []), 3: (1, []), 5: (1, []), 6: (1, [0])}
    terms, vectors = TM.tfidf_vectors(df.limit(0), "id", "t", [])
    assert terms.count() == 0 and vectors.count() == 0


def test_vocabulary_is_capped_by_count_then_word(spark):
    df = spark.createDataFrame([(1, "b b a c"), (2, "c a b")], "id long, t string")
    terms, vectors = TM.tfidf_vectors(df, "id", "t", [], vocab_size=2, min_df=1)
    assert {r.word: r.term_index for r in terms.collect()} == {"b": 0, "a": 1}
    assert all(r.tfidf.size == 2 for r in vectors.collect())


def test_features_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "x", "a b", 1.0), (2, "y", "b", 0.0), (3, "y", None, 0.0)], "id long, e string, t string, label double")
    terms, feats = TM.featurize(df, "id", "t", [], ["id", "e", "label"], min_df=1)
    assert feats.columns == ["id", "e", "label", "tfidf"]
    assert sorted(r.id for r in feats.collect()) == [1, 2]
    lr = TM.logreg("label", 0.1).fit(feats)
    assert {r.word: r.weight for r in TM.word_weights(terms, lr).collect()}.keys() == {"a", "b"}
    feats.unpersist()
