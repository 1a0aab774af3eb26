"""Text models (M9-M14), word-weight tables (M11, G6, O2) and the entity
report (E6).

The TF-IDF features are fitted once (on the training split by default, or
on all reviews to reproduce the reference's first model), assembled from the relational word counts
(the vocabulary stays a table) and persisted;
the parameter grid then only refits the logistic regression, all grid points in one job an
iteration (``gridfit``), over the same vectors. Grid points that are the same model
(regParam 0 with any elastic-net mix) are fitted once and reported for
each grid point. All grid models are scored in ONE pass over the
validation rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinio.functions.columns import letter_tokens, match_flag
from opinio.operators.aggregate import mean_with_error
from opinio.operators.joins import join_checked
from opinio.operators.partition import persist_for_iterations
from opinio.operators.text import MIN_DF, VOCAB_SIZE, by_document, sparse_vectors, vocabulary, without_stop_words
from opinio.plans.gridfit import fit_grid
from opinio.sources.readers import land, land_bucketed


def tfidf_vectors(df: DataFrame, doc: str, text: str, stop_words: list[str], vocab_size: int | None = VOCAB_SIZE,
                  min_df: float = MIN_DF, fit_filter=None) -> tuple[DataFrame, DataFrame]:
    """``(word, term_index, idf)`` and ``(doc, tfidf)`` sparse vectors of every row with text (empty where it holds no word
    of the vocabulary). ``doc`` identifies the rows; vocabulary and IDF come from the rows that meet ``fit_filter``.

    The texts are dealt by document and tokenised once, into ``(doc, word, n)`` rows landed in buckets of the document;
    vocabulary ranks, IDF and vectors follow by aggregations and one join by word, and the rows of a document are
    gathered where they lie. The vocabulary is never collected."""
    rows = df.where(F.col(text).isNotNull())
    fit = F.lit(True) if fit_filter is None else fit_filter
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(fit).alias("fit")).first()
    n_docs = sizes["fit"]
    dealt, tasks = by_document(rows.select(doc, F.coalesce(fit, F.lit(False)).alias("_fit"), F.col(text).alias("_text")), doc, sizes["rows"])
    tokens = without_stop_words(letter_tokens("_text"), stop_words)
    # documents without words stay as one row whose word is NULL
    counts = land_bucketed(dealt.select(doc, "_fit", F.explode_outer(tokens).alias("word"))
                           .groupBy(doc, "_fit", "word").agg(F.count("word").alias("n")), "word_counts", doc, tasks)
    vocab = vocabulary(counts.where(F.col("_fit") & F.col("word").isNotNull()), min_df=min_df,
                       vocab_size=vocab_size, n_docs=n_docs)
    idf = F.log((F.lit(n_docs) + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0)))
    terms = land(vocab.select("word", F.col("term_index").cast("int").alias("term_index"), idf.alias("idf")), "terms")
    entries = join_checked(counts, terms, "word", "left").withColumn("_v", F.col("n") * F.col("idf"))
    return terms, sparse_vectors(entries, doc, "term_index", "_v", terms.count(), "tfidf")


def featurize(df: DataFrame, doc: str, text: str, stop_words: list[str], keep: list[str],
              vocab_size: int | None = VOCAB_SIZE, min_df: float = MIN_DF, fit_filter=None) -> tuple[DataFrame, DataFrame]:
    """``tfidf_vectors`` with the columns ``keep`` (``doc`` among them), persisted for iterative fits; the caller unpersists."""
    terms, vectors = tfidf_vectors(df, doc, text, stop_words, vocab_size, min_df, fit_filter)
    return terms, persist_for_iterations(df.select(*keep).join(vectors, doc).select(*keep, "tfidf"))


def logreg(label: str, reg_param: float = 0.0, elastic_net: float = 0.0,
           max_iter: int = 100) -> LogisticRegression:
    return LogisticRegression(featuresCol="tfidf", labelCol=label,
                              regParam=reg_param, elasticNetParam=elastic_net,
                              maxIter=max_iter)


def word_weights(terms: DataFrame, lr_model) -> DataFrame:
    """``(word, weight)``: the coefficients (bounded by the vocabulary's size), by their index, beside their words."""
    w = lr_model.coefficients.toArray()
    weights = terms.sparkSession.createDataFrame(
        pd.DataFrame({"term_index": range(len(w)), "weight": w}), "term_index int, weight double")
    return terms.join(weights, "term_index").select("word", "weight")


def effective_key(reg: float, en: float) -> tuple[float, float]:
    """With no regularisation the elastic-net mix is irrelevant."""
    return (reg, en) if reg > 0 else (0.0, 0.0)


GRID_SCHEMA = T.StructType([
    T.StructField("grid_index", T.IntegerType()),
    T.StructField("reg_param", T.DoubleType()),
    T.StructField("elastic_net_param", T.DoubleType()),
    T.StructField("accuracy", T.DoubleType()),
])


def grid_search(spark: SparkSession, train: DataFrame, validation: DataFrame,
                label: str, reg_params: list[float], elastic_nets: list[float],
                max_iter: int = 100):
    """Fit every grid point (regParam-major order; all at once, one job an iteration), score all on
    the validation rows in one pass. Returns (results DataFrame, models by grid
    index)."""
    grid = [(r, e) for r in reg_params for e in elastic_nets]
    distinct = sorted({effective_key(r, e) for r, e in grid})

    fitted = dict(zip(distinct, fit_grid(train, label, distinct, max_iter)))
    scored = validation
    for j, key in enumerate(distinct):
        m = fitted[key].copy()
        m.setPredictionCol(f"_p{j}").setRawPredictionCol("").setProbabilityCol("")
        scored = m.transform(scored)
    accs = scored.agg(*[F.avg(match_flag(f"_p{j}", label)).alias(f"a{j}")
                        for j in range(len(distinct))]).first()
    by_key = {key: accs[f"a{j}"] for j, key in enumerate(distinct)}
    rows = [(i, r, e, by_key[effective_key(r, e)]) for i, (r, e) in enumerate(grid)]
    models = {i: fitted[effective_key(r, e)] for i, (r, e) in enumerate(grid)}
    return spark.createDataFrame(rows, GRID_SCHEMA), models


def entity_report(scored: DataFrame, entity: str, threshold: int,
                  prediction: str = "prediction") -> DataFrame:
    """Entities with more than ``threshold`` scored reviews: count, mean
    prediction and 2 standard errors -- one partial aggregation, the busy
    filter applied to its result (no second pass, no entity list)."""
    rep = mean_with_error(scored, entity, prediction, "prediction", "err",
                          count_alias="review_count")
    return rep.where(F.col("review_count") > threshold)


__all__ = ["featurize", "tfidf_vectors", "logreg", "word_weights", "grid_search", "entity_report"]
