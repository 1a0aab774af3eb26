"""Registered queries: every operator of the inventory run over the whole
test tables, each with its independent DuckDB SQL where SQL can express it.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> str``.
Doubles are rounded to 6 decimals (or 7 significant digits for tiny
coefficients) on both sides so engines agree on the last bits.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio import oracle as O
from opinio.functions.columns import (
    label_int,
    lenient_double,
    letter_tokens,
    match_flag,
    polarity,
    significant,
    whitespace_tokens,
)
from opinio.functions.stopwords import bundled_stop_words
from opinio.operators import aggregate as agg
from opinio.operators import clean, split, text
from opinio.operators.joins import split_hot_join
from opinio.operators.partition import persist_for_iterations
from opinio.plans import classify as CL
from opinio.plans import lexicon as lx
from opinio.plans import metrics as M
from opinio.plans import regression as RG
from opinio.plans import textmodels as TM
from opinio.plans import views as V
from opinio.session import scratch_path
from opinio.sources import readers
from opinio.sources.csv_split import read_split_csv
from opinio.sources.models import forest_nodes, load_model, model_path, save_model
from opinio.sources.readers import land
from opinio.specs import ELASTIC_NET_PARAMS, REG_PARAMS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    """Round to 6 decimals; ``+ 0.0`` turns a rounded -0.0 into 0.0."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6) + F.lit(0.0)


STOP_WORDS = bundled_stop_words("english")
BUSY_LANG_THRESHOLD = 120
ENTITY_LIST = ["src1", "src3", "src7", "src11"]
FILL = {"l_discount": 0.05, "l_tax": 0.04}


# ------------------------------------------------------------ lexicon ----

@query("lexicon_entity_sentiment", f"""
WITH {O.LEXICON_CTE},
toks AS (SELECT source, unnest({O.letters('text')}) AS word
         FROM documents WHERE text IS NOT NULL)
SELECT source, round(avg(sentiment), 6) AS avg_sentiment,
       CAST(CASE WHEN avg(sentiment) > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS predicted
FROM toks JOIN lex USING (word) GROUP BY source""")
def q_lexicon_entity_sentiment(spark, d):
    out = lx.entity_sentiment(V.docs(spark, d), "source", "text",
                              V.lexicon(spark, d))
    return out.select("source", r6("avg_sentiment").alias("avg_sentiment"),
                      "predicted")


@query("lexicon_coverage", f"""
WITH {O.LEXICON_CTE},
toks AS (SELECT source, unnest({O.letters('text')}) AS word
         FROM documents WHERE text IS NOT NULL)
SELECT source, count(*) AS n_words, count(sentiment) AS n_scored,
       round(count(sentiment) / count(*), 6) AS coverage
FROM toks LEFT JOIN lex USING (word) GROUP BY source""")
def q_lexicon_coverage(spark, d):
    out = lx.lexicon_coverage(V.docs(spark, d), "source", "text", V.lexicon(spark, d))
    return out.select("source", "n_words", "n_scored", r6("coverage").alias("coverage"))


_REVIEW_POLARITY_SQL = f"""{O.LEXICON_CTE}, {O.REVIEWS_CTE},
pol AS (SELECT source,
               CAST(CASE WHEN avg(sentiment) > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS predicted
        FROM (SELECT source, unnest({O.letters('text')}) AS word
              FROM reviews WHERE text IS NOT NULL) t
        JOIN lex USING (word) GROUP BY source)"""


def _review_polarity(spark, d):
    return lx.entity_sentiment(V.reviews(spark, d), "source", "text",
                               V.lexicon(spark, d)).select("source", "predicted")


@query("lexicon_accuracy", f"""
WITH {_REVIEW_POLARITY_SQL}
SELECT round(avg(CAST(quality = predicted AS DOUBLE)), 6) AS accuracy
FROM reviews JOIN pol USING (source)""")
def q_lexicon_accuracy(spark, d):
    out = lx.lexicon_accuracy(V.reviews(spark, d), "source", "quality",
                              _review_polarity(spark, d))
    return out.select(r6("accuracy").alias("accuracy"))


@query("entity_prediction_join", f"""
WITH {_REVIEW_POLARITY_SQL}
SELECT doc_id, source, quality, predicted FROM reviews JOIN pol USING (source)""")
def q_entity_prediction_join(spark, d):
    return lx.entity_prediction_join(
        V.reviews(spark, d).select("doc_id", "source", "quality"), "source",
        _review_polarity(spark, d))


@query("match_flag", f"""
WITH {_REVIEW_POLARITY_SQL}
SELECT doc_id, CAST(quality = predicted AS DOUBLE) AS correct
FROM reviews JOIN pol USING (source)""")
def q_match_flag(spark, d):
    joined = lx.entity_prediction_join(
        V.reviews(spark, d).select("doc_id", "source", "quality"), "source",
        _review_polarity(spark, d))
    return joined.select("doc_id", match_flag("quality", "predicted").alias("correct"))


@query("accuracy", f"""
WITH {_REVIEW_POLARITY_SQL}
SELECT {O.split_of('doc_id')} AS split,
       round(avg(CAST(quality = predicted AS DOUBLE)), 6) AS accuracy
FROM reviews JOIN pol USING (source) GROUP BY 1""")
def q_accuracy(spark, d):
    tagged = split.hash_split(V.reviews(spark, d), "doc_id")
    out = lx.lexicon_accuracy(tagged, "source", "quality",
                              _review_polarity(spark, d), by=["split"])
    return out.select("split", r6("accuracy").alias("accuracy"))


@query("token_lexicon_join", f"""
WITH {O.LEXICON_CTE}
SELECT doc_id, word, sentiment
FROM (SELECT doc_id, unnest({O.letters('text')}) AS word FROM documents) t
JOIN lex USING (word)""")
def q_token_lexicon_join(spark, d):
    words = V.docs(spark, d).select(
        "doc_id", F.explode(letter_tokens("text")).alias("word"))
    return lx.token_lexicon_join(words, V.lexicon(spark, d)).select(
        "doc_id", "word", "sentiment")


@query("token_lexicon_split_join", ORACLE["token_lexicon_join"])
def q_token_lexicon_split_join(spark, d):
    """The same join as for a lexicon past the broadcast limit: frequent words by broadcast, the rest by shuffle."""
    words = V.docs(spark, d).select("doc_id", F.explode(letter_tokens("text")).alias("word"))
    return split_hot_join(words, V.lexicon(spark, d), "word").select("doc_id", "word", "sentiment")


@query("conditional_polarity", f"""
WITH {O.RATINGS_CTE}
SELECT l_suppkey, round(avg(label) - 0.5, 6) AS avg_centered,
       CAST(CASE WHEN avg(label) - 0.5 > 0 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS predicted
FROM ratings GROUP BY l_suppkey""")
def q_conditional_polarity(spark, d):
    g = V.ratings(spark, d).groupBy("l_suppkey").agg(
        (F.avg("label") - F.lit(0.5)).alias("avg_centered"))
    return g.select("l_suppkey", r6("avg_centered").alias("avg_centered"),
                    polarity("avg_centered").alias("predicted"))


# -------------------------------------------------------------- tokens ----

def _pos_sql(arr_sql: str, src: str = "documents", key: str = "doc_id") -> str:
    return (f"SELECT {key}, CAST(unnest(range(len(a))) AS INTEGER) AS pos, "
            f"unnest(a) AS word FROM (SELECT {key}, {arr_sql} AS a FROM {src}) t")


@query("tokenize_whitespace", _pos_sql(O.ws_tokens("text")))
def q_tokenize_whitespace(spark, d):
    return text.explode_tokens(V.docs(spark, d), ["doc_id"],
                               whitespace_tokens("text"), with_pos=True)


@query("tokenize_letters", _pos_sql(O.letters("text")))
def q_tokenize_letters(spark, d):
    return text.explode_tokens(V.docs(spark, d), ["doc_id"],
                               letter_tokens("text"), with_pos=True)


_FILTERED = f"list_filter({O.letters('text')}, lambda w: lower(w) NOT IN ({O.STOPS}))"


@query("remove_stopwords", _pos_sql(_FILTERED))
def q_remove_stopwords(spark, d):
    toks = text.without_stop_words(letter_tokens("text"), STOP_WORDS)
    return text.explode_tokens(V.docs(spark, d), ["doc_id"], toks, with_pos=True)


@query("explode_words", f"""
SELECT source, unnest({O.letters('text')}) AS word FROM documents""")
def q_explode_words(spark, d):
    return text.explode_tokens(V.docs(spark, d), ["source"], letter_tokens("text"))


@query("term_counts", f"""
SELECT doc_id, word, count(*) AS n
FROM (SELECT doc_id, unnest({O.ws_tokens('text')}) AS word FROM documents) t
GROUP BY doc_id, word""")
def q_term_counts(spark, d):
    words = text.explode_tokens(V.docs(spark, d), ["doc_id"],
                                whitespace_tokens("text"))
    return text.term_counts(words, "doc_id")


_COUNTS_SQL = f"""counts AS (
  SELECT doc_id, word, count(*) AS n
  FROM (SELECT doc_id, unnest({_FILTERED}) AS word FROM documents) t
  GROUP BY doc_id, word),
vocab AS (
  SELECT word, count(*) AS doc_freq, CAST(sum(n) AS BIGINT) AS term_count,
         CAST(row_number() OVER (ORDER BY sum(n) DESC, word) - 1 AS INTEGER) AS term_index
  FROM counts GROUP BY word HAVING count(*) >= 5),
idf AS (
  SELECT word, doc_freq,
         ln(((SELECT count(text) FROM documents) + 1.0) / (doc_freq + 1.0)) AS idf
  FROM vocab)"""


def _counts(spark, d, docs=None):
    toks = text.without_stop_words(letter_tokens("text"), STOP_WORDS)
    words = text.explode_tokens(V.docs(spark, d) if docs is None else docs, ["doc_id"], toks)
    return text.term_counts(words, "doc_id")


def _idf(spark, d, counts=None):
    # documents without text are no documents to the fitted pipeline either
    n_docs = V.table(spark, d, "documents", spread_out=False).where(F.col("text").isNotNull()).count()
    vocab = text.vocabulary(counts if counts is not None else _counts(spark, d), indexed=False)
    return text.idf_weights(vocab, n_docs)


@query("pruned_vocabulary", f"""
WITH {_COUNTS_SQL}
SELECT word, doc_freq, term_count, term_index FROM vocab""")
def q_pruned_vocabulary(spark, d):
    v = text.vocabulary(_counts(spark, d))
    return v.select("word", "doc_freq", "term_count",
                    F.col("term_index").cast("int").alias("term_index"))


@query("capped_vocabulary", f"""
WITH {_COUNTS_SQL}
SELECT word, doc_freq, term_count, term_index FROM vocab WHERE term_index < 100""")
def q_capped_vocabulary(spark, d):
    """The vocabulary cut (a feature of the count vectoriser) at 100 words."""
    v = text.vocabulary(_counts(spark, d), vocab_size=100)
    return v.select("word", "doc_freq", "term_count",
                    F.col("term_index").cast("int").alias("term_index"))


@query("idf_weights", f"""
WITH {_COUNTS_SQL}
SELECT word, doc_freq, round(idf, 6) AS idf FROM idf""")
def q_idf_weights(spark, d):
    return _idf(spark, d).select("word", "doc_freq", r6("idf").alias("idf"))


@query("tfidf", f"""
WITH {_COUNTS_SQL}
SELECT doc_id, word, round(n * idf, 6) AS tfidf FROM counts JOIN idf USING (word)""")
def q_tfidf(spark, d):
    # one landed (doc, word, n) table feeds both the vocabulary and the product; the texts are shuffled, not their words
    docs = V.table(spark, d, "documents", spread_out=False).select("doc_id", "text")
    dealt, _ = text.by_document(docs, "doc_id", docs.count())
    counts = land(_counts(spark, d, dealt), "word-counts")
    out = text.tfidf(counts, land(_idf(spark, d, counts), "idf"), "doc_id")
    return out.select("doc_id", "word", r6("tfidf").alias("tfidf"))


@query("top_bottom_words", f"""
WITH {_COUNTS_SQL},
b AS (SELECT 'bottom' AS "end", word, idf,
             CAST(row_number() OVER (ORDER BY idf, word) AS INTEGER) AS rank FROM idf),
t AS (SELECT 'top' AS "end", word, idf,
             CAST(row_number() OVER (ORDER BY idf DESC, word) AS INTEGER) AS rank FROM idf)
SELECT "end", rank, word, round(idf, 6) AS idf FROM b WHERE rank <= 15
UNION ALL
SELECT "end", rank, word, round(idf, 6) AS idf FROM t WHERE rank <= 15""")
def q_top_bottom_words(spark, d):
    out = agg.top_bottom(_idf(spark, d).select("word", "idf"), "idf", "word", 15)
    return out.select("end", F.col("rank").cast("int").alias("rank"), "word",
                      r6("idf").alias("idf"))


@query("tfidf_vectors", f"""
WITH {_COUNTS_SQL}
SELECT doc_id, CAST((SELECT count(*) FROM vocab) AS INTEGER) AS size,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY term_index) - 1 AS INTEGER) AS pos, term_index,
       round(n * idf, 6) AS tfidf
FROM counts JOIN idf USING (word) JOIN vocab USING (word)
UNION ALL
SELECT doc_id, CAST((SELECT count(*) FROM vocab) AS INTEGER), -1, -1, 0.0 FROM documents
WHERE text IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM counts JOIN vocab USING (word))""")
def q_tfidf_vectors(spark, d):
    """The sparse vectors of every document, entry by entry in the order they hold (an empty vector: one row at -1)."""
    _, vectors = TM.tfidf_vectors(V.docs(spark, d), "doc_id", "text", list(STOP_WORDS), vocab_size=None)
    parts = F.unwrap_udt("tfidf")
    pairs = F.posexplode_outer(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("v"))).alias("pos", "_p")
    return vectors.select("doc_id", parts["size"].alias("size"), pairs).select(
        "doc_id", "size", F.coalesce("pos", F.lit(-1)).alias("pos"), F.coalesce("_p.i", F.lit(-1)).alias("term_index"),
        r6(F.coalesce("_p.v", F.lit(0.0))).alias("tfidf"))


@query("model_roundtrip", f"""
WITH {_COUNTS_SQL}
SELECT doc_id, word, round(n * idf, 6) AS tfidf FROM counts JOIN idf USING (word)""")
def q_model_roundtrip(spark, d):
    """Tokeniser to IDF fitted, stored, loaded again, and the loaded pipeline applied to every document."""
    docs = V.docs(spark, d).where(F.col("text").isNotNull()).select("doc_id", "text")
    fitted = text.tfidf_estimator("text", list(STOP_WORDS)).fit(docs)
    version = save_model(spark, fitted, "documents-tfidf", notes={"input": "documents"})
    model = load_model(spark, "documents-tfidf", version)
    return text.words_of_vectors(model.transform(docs), model, ["doc_id"]).select(
        "doc_id", "word", r6("tfidf").alias("tfidf"))


# ------------------------------------------------------------- sources ----

@query("csv_review_scan",
       "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_review_scan(spark, d):
    src = V.docs(spark, d).select("doc_id", "text", "lang", "source", "n_chars")
    path = readers.write_csv(src, scratch_path(spark, "documents-csv"))
    return readers.read_review_csv(spark, path, src.schema)


@query("csv_split_scan", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_split_scan(spark, d):
    """As ``csv_review_scan``, each file read by as many tasks as it has byte ranges."""
    src = V.docs(spark, d).select("doc_id", "text", "lang", "source", "n_chars")
    path = readers.write_csv(src, scratch_path(spark, "documents-csv"))
    return read_split_csv(spark, path, src.schema)


_POSITIONAL = ["review_id", "content", "language", "entity", "length"]


@query("positional_rename", """
SELECT CAST(doc_id AS VARCHAR) AS review_id, text AS content, lang AS language,
       source AS entity, CAST(n_chars AS VARCHAR) AS length FROM documents""")
def q_positional_rename(spark, d):
    src = V.docs(spark, d).select("doc_id", "text", "lang", "source", "n_chars")
    path = readers.write_csv(src, scratch_path(spark, "documents-raw"),
                             header=False)
    raw = readers.read_review_csv(spark, path, None, header=False)
    return clean.rename_positional(raw, _POSITIONAL)


@query("lexicon_scan", f"WITH {O.LEXICON_CTE} SELECT word, sentiment FROM lex")
def q_lexicon_scan(spark, d):
    path = scratch_path(spark, "lexicon")
    V.lexicon(spark, d).write.mode("overwrite").parquet(path)
    return readers.read_lexicon(spark, path)


@query("corpus_count", "SELECT count(*) AS n FROM benchmark")
def q_corpus_count(spark, d):
    return readers.corpus_count(spark, f"{d}/benchmark.parquet")


@query("stopword_load", r"""
SELECT w AS word FROM (SELECT unnest(regexp_split_to_array(text, '\s+')) AS w
                       FROM documents) t WHERE w <> ''""")
def q_stopword_load(spark, d):
    path = scratch_path(spark, "wordlist")
    V.docs(spark, d).select("text").write.mode("overwrite").text(path)
    return readers.read_word_list(spark, path)


@query("weights_csv_sink", f"""
WITH {_COUNTS_SQL}
SELECT word, round(idf, 6) AS weight FROM idf""")
def q_weights_csv_sink(spark, d):
    w = _idf(spark, d).select("word", F.col("idf").alias("weight"))
    path = readers.write_csv(w, scratch_path(spark, "weights-csv"))
    back = readers.read_review_csv(spark, path, w.schema)
    return back.select("word", r6("weight").alias("weight"))


# -------------------------------------------- casts, filters, missing ----

def _cell():
    """The whole value of ``k``; every eleventh cell is made malformed."""
    value = F.regexp_extract("props", r'"k":\s*([^,}]*)', 1)
    return F.when(F.col("event_id") % 11 == 5, F.concat(value, F.lit("}"))).otherwise(value)


_CELL = """CASE WHEN event_id % 11 = 5 THEN regexp_extract(props, '"k":\\s*([^,}]*)', 1) || '}'
       ELSE regexp_extract(props, '"k":\\s*([^,}]*)', 1) END"""


@query("cast_ratings", f"""
SELECT event_id, TRY_CAST({_CELL} AS DOUBLE) AS rating FROM events""")
def q_cast_ratings(spark, d):
    ev = V.table(spark, d, "events")
    return ev.select("event_id",
                     lenient_double(_cell()).alias("rating"))


@query("cast_label", f"""
SELECT event_id,
       CAST(TRY_CAST(trunc(TRY_CAST({_CELL} AS DOUBLE)) AS INTEGER) AS DOUBLE)
         AS label
FROM events""")
def q_cast_label(spark, d):
    # the double form of the label cast (int via double, then double), so a
    # NULL label stays a plain NULL double in every client
    ev = V.table(spark, d, "events")
    return ev.select("event_id", label_int(_cell())
                     .cast("double").alias("label"))


@query("drop_columns", "SELECT doc_id, lang, source FROM documents")
def q_drop_columns(spark, d):
    return clean.drop_columns(V.docs(spark, d), ["text", "n_chars"])


@query("labelled_only", f"""
WITH {O.RATINGS_ALL_CTE}
SELECT l_orderkey, line, label FROM ratings_all WHERE label IN (0, 1)""")
def q_labelled_only(spark, d):
    r = V.ratings(spark, d, labelled_only=False)
    return clean.labelled_only(r, "label").select("l_orderkey", "line", "label")


@query("union_labelled", f"""
WITH {O.RATINGS_ALL_CTE}
SELECT l_orderkey, line, label FROM ratings_all WHERE label = 1
UNION ALL
SELECT l_orderkey, line, label FROM ratings_all WHERE label = 0""")
def q_union_labelled(spark, d):
    r = V.ratings(spark, d, labelled_only=False).select("l_orderkey", "line", "label")
    return clean.union_by_label(r, "label", (1, 0))


@query("drop_missing_text", """
SELECT doc_id, source FROM documents
WHERE (CASE WHEN n_chars < 200 THEN NULL ELSE text END) IS NOT NULL""")
def q_drop_missing_text(spark, d):
    docs = V.docs(spark, d).withColumn(
        "text", F.when(F.col("n_chars") < 200, F.lit(None)).otherwise(F.col("text")))
    return clean.drop_missing(docs, ["text"]).select("doc_id", "source")


@query("non_null_count", f"""
WITH {O.RATINGS_CTE} SELECT count(*) AS n FROM ratings WHERE l_discount IS NOT NULL""")
def q_non_null_count(spark, d):
    return clean.non_null_count(V.ratings(spark, d), "l_discount")


@query("fill_constants", f"""
WITH {O.RATINGS_CTE}
SELECT l_orderkey, line, coalesce(l_discount, 0.05) AS l_discount,
       coalesce(l_tax, 0.04) AS l_tax FROM ratings""")
def q_fill_constants(spark, d):
    r = V.ratings(spark, d).select("l_orderkey", "line", "l_discount", "l_tax")
    return clean.fill_constants(r, FILL)


@query("impute_mean", f"""
WITH {O.RATINGS_CTE},
m AS (SELECT avg(l_discount) AS md, avg(l_tax) AS mt FROM ratings WHERE split = 'train')
SELECT l_orderkey, line, split, round(coalesce(l_discount, md), 6) AS l_discount,
       round(coalesce(l_tax, mt), 6) AS l_tax FROM ratings, m""")
def q_impute_mean(spark, d):
    out = _filled_ratings(spark, d)
    return out.select("l_orderkey", "line", "split",
                      r6("l_discount").alias("l_discount"),
                      r6("l_tax").alias("l_tax"))


@query("entity_subset", f"""
SELECT source, round(avg(n_chars), 6) AS prediction,
       round(2 * stddev_samp(n_chars) / sqrt(count(*)), 6) AS err
FROM documents WHERE source IN ({', '.join(repr(s) for s in ENTITY_LIST)})
GROUP BY source""")
def q_entity_subset(spark, d):
    rep = agg.mean_with_error(V.docs(spark, d), "source", "n_chars")
    sub = clean.entity_subset(rep, "source", ENTITY_LIST)
    return sub.select("source", r6("prediction").alias("prediction"),
                      r6("err").alias("err"))


# -------------------------------------------------------- aggregations ----

@query("rating_means", f"""
WITH {O.RATINGS_CTE}
SELECT {', '.join(f'round(avg({c}), 6) AS avg_{c}' for c in V.RATING_FEATURES)}
FROM ratings""")
def q_rating_means(spark, d):
    m = agg.column_means(V.ratings(spark, d), V.RATING_FEATURES)
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query("busy_entities", f"""
SELECT lang, count(*) AS review_count FROM documents GROUP BY lang
HAVING count(*) > {BUSY_LANG_THRESHOLD}""")
def q_busy_entities(spark, d):
    return agg.busy_entities(V.docs(spark, d), "lang", BUSY_LANG_THRESHOLD)


@query("entity_mean_2se", """
SELECT event_type, round(avg(value), 6) AS prediction,
       round(2 * stddev_samp(value) / sqrt(count(*)), 6) AS err,
       count(*) AS n
FROM events GROUP BY event_type""")
def q_entity_mean_2se(spark, d):
    rep = agg.mean_with_error(V.table(spark, d, "events"), "event_type",
                              "value", count_alias="n")
    return rep.select("event_type", r6("prediction").alias("prediction"),
                      r6("err").alias("err"), "n")


@query("split_counts", f"""
WITH {O.RATINGS_CTE} SELECT split, count(*) AS n FROM ratings GROUP BY split""")
def q_split_counts(spark, d):
    return split.split_counts(V.ratings_split(spark, d))


@query("hash_split", f"""
WITH {O.RATINGS_CTE} SELECT l_orderkey, line, split FROM ratings""")
def q_hash_split(spark, d):
    return V.ratings_split(spark, d).select("l_orderkey", "line", "split")


@query("random_split")
def q_random_split(spark, d):
    r = V.reviews(spark, d).select("doc_id", "source", "quality")
    return split.random_split(r, (0.6, 0.3, 0.1), seed=0)


# ------------------------------------------------------ least squares ----

FEATURES = list(V.RATING_FEATURES)
RUNS = [(list(names), fit, score) for names, fit, score in V.RATINGS.ols_runs]


def _filled_ratings(spark, d):
    """Labelled, split ratings; discount/tax NULLs filled with TRAINING
    means (no leakage from validation/test). Means, fits and scores read one landed copy."""
    r = V.landed_ratings(spark, d)
    return clean.impute_mean(r.where(F.col("split") == "train"), r,
                             ["l_discount", "l_tax"])


@query("assemble_ratings", f"""
WITH {O.RATINGS_CTE}, {O.filled_ratings_cte(FEATURES)}
SELECT l_orderkey, line, {', '.join(f'round({f}, 6) AS {f}' for f in FEATURES)}
FROM filled""")
def q_assemble_ratings(spark, d):
    vec = RG.assemble(_filled_ratings(spark, d), FEATURES, "features")
    out = RG.unpack(vec, "features", FEATURES, ["l_orderkey", "line"])
    return out.select("l_orderkey", "line", *[r6(f).alias(f) for f in FEATURES])


@query("order_ratings", f"""
WITH {O.RATINGS_CTE}
SELECT l_orderkey, count(*) AS n, round(avg(l_quantity), 6) AS avg_quantity, max(o_totalprice) AS o_totalprice
FROM ratings GROUP BY l_orderkey""")
def q_order_ratings(spark, d):
    """Ratings per order from tables in buckets of the order key: neither the join nor the grouping shuffles."""
    out = V.ratings(spark, d, bucketed=True).groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("avg_quantity"), F.max("o_totalprice").alias("o_totalprice"))
    return out.select("l_orderkey", "n", r6("avg_quantity").alias("avg_quantity"), "o_totalprice")


@query("standardize", f"""
WITH {O.RATINGS_CTE}, {O.filled_ratings_cte(FEATURES)},
st AS (SELECT {', '.join(f'avg({f}) AS m_{f}, stddev_samp({f}) AS s_{f}' for f in FEATURES)}
       FROM filled WHERE split = 'train')
SELECT l_orderkey, line,
       {', '.join(f'round(({f} - m_{f}) / s_{f}, 6) + 0.0 AS z_{f}' for f in FEATURES)}
FROM filled, st""")
def q_standardize(spark, d):
    f = _filled_ratings(spark, d)
    out = RG.standardize(f.where(F.col("split") == "train"), f, FEATURES,
                         ["l_orderkey", "line"])
    return out.select("l_orderkey", "line",
                      *[r6("z_" + c).alias("z_" + c) for c in FEATURES])


@query("ols_coefficients", O.ols_coefficients_sql(RUNS[0][0], "train"))
def q_ols_coefficients(spark, d):
    f = _filled_ratings(spark, d)
    feats = RUNS[0][0]
    model = RG.fit_ols(f.where(F.col("split") == "train"), feats, "label")
    tab = RG.coefficient_table(spark, model, feats)
    return tab.select("column", significant("weight").alias("weight"))


@query("subset_mse_report", O.subset_mse_sql(RUNS))
def q_subset_mse_report(spark, d):
    rep = RG.subset_mse_report(spark, _filled_ratings(spark, d), "label", RUNS)
    return rep.select("run", "features", "fit_on", "score_on", "n_fit",
                      "n_score", r6("mse").alias("mse"))


@query("mse", O.ols_mse_sql(RUNS[0][0], "train", "validation"))
def q_mse(spark, d):
    f = _filled_ratings(spark, d)
    model = RG.fit_ols(f.where(F.col("split") == "train"), RUNS[0][0], "label")
    scored = model.transform(f.where(F.col("split") == "validation"))
    return M.mse(scored, "prediction", "label").select(r6("mse").alias("mse"))


@query("best_by_metric", f"""
WITH rep AS ({O.subset_mse_sql(RUNS)})
SELECT run, features, mse FROM rep WHERE score_on = 'validation'
ORDER BY mse, run LIMIT 1""")
def q_best_by_metric(spark, d):
    rep = RG.subset_mse_report(spark, _filled_ratings(spark, d), "label", RUNS)
    rep = rep.where(F.col("score_on") == "validation")
    # chosen on exact values, rounded after
    return agg.best_by(rep, "mse", ["run"], descending=False).select(
        "run", "features", r6("mse").alias("mse"))


@query("scored_preview", O.ols_preview_sql(RUNS[10][0], "train", "test", 20))
def q_scored_preview(spark, d):
    """Run 11's model scores the test split; first 20 negatives by key (a
    top-20, the feature itself)."""
    f = _filled_ratings(spark, d)
    model = RG.fit_ols(f.where(F.col("split") == "train"), RUNS[10][0], "label")
    scored = model.transform(f.where(F.col("split") == "test"))
    return (scored.select("l_orderkey", "line", "l_suppkey",
                          r6("prediction").alias("prediction"), "label")
            .where(F.col("label") == 0).orderBy("l_orderkey", "line").limit(20))


@query("auc", f"""
WITH {O.RATINGS_CTE},
g AS (SELECT split, CAST(l_quantity AS DOUBLE) AS score,
             CAST(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS pos,
             CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS neg
      FROM ratings GROUP BY split, l_quantity),
c AS (SELECT split, pos, neg,
             coalesce(sum(neg) OVER (PARTITION BY split ORDER BY score
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM g)
SELECT split, round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc
FROM c GROUP BY split""")
def q_auc(spark, d):
    r = V.ratings_split(spark, d)
    out = M.area_under_roc(r, "l_quantity", "label", by=["split"])
    return out.select("split", r6("auc").alias("auc"))


# --------------------------------------------------------- classifiers ----

SUB_RATINGS = FEATURES[1:]          # the seven ratings without "overall"
# Display names of the synthetic rating columns.
DISPLAY_NAMES = {
    "l_extendedprice": "EXTENDED PRICE", "l_discount": "DISCOUNT",
    "l_tax": "TAX", "l_linenumber": "LINE NUMBER",
    "o_totalprice": "ORDER TOTAL", "p_size": "PART SIZE",
    "p_retailprice": "RETAIL PRICE",
}
BUSY_SOURCE_THRESHOLD = 15


def _labelled_double(spark, d):
    return _filled_ratings(spark, d).withColumn("label", F.col("label").cast("double"))


def _logreg_model(spark, d):
    f = persist_for_iterations(_labelled_double(spark, d))
    return f, CL.logreg_estimator(SUB_RATINGS, "label", 0.1).fit(
        f.where(F.col("split") == "train"))


def _forest_model(spark, d):
    f = persist_for_iterations(_labelled_double(spark, d))
    return f, CL.forest_estimator(SUB_RATINGS, "label", seed=42).fit(
        f.where(F.col("split") == "train"))


def _classifier_report(f, model):
    scored = CL.positive_probability(model.transform(f), "score")
    aucs = M.area_under_roc(scored, "score", "label", by=["split"])
    stats = scored.groupBy("split").agg(
        F.avg("score").alias("mean_probability"),
        F.avg("label").alias("label_rate"),
        F.avg(match_flag("prediction", "label")).alias("accuracy"))
    return aucs.join(stats, "split")


@query("ratings_logreg")
def q_ratings_logreg(spark, d):
    f, model = _logreg_model(spark, d)
    return _classifier_report(f, model)


@query("logreg_calibration", f"""
WITH {O.RATINGS_CTE}
SELECT count(*) AS n, round(avg(CAST(label AS DOUBLE)), 4) AS mean_probability,
       round(avg(CAST(label AS DOUBLE)), 4) AS label_rate
FROM ratings WHERE split = 'train'""")
def q_logreg_calibration(spark, d):
    """The intercept is not penalised, so at the optimum the mean probability is the label rate."""
    f, model = _logreg_model(spark, d)
    scored = CL.positive_probability(model.transform(f.where(F.col("split") == "train")), "score")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("score"), 4).alias("mean_probability"),
                      F.round(F.avg("label"), 4).alias("label_rate"))


@query("logreg_score_equations",
       "SELECT unnest(['intercept', " + ", ".join(f"'{f}'" for f in SUB_RATINGS) + "]) AS equation, true AS settled")
def q_logreg_score_equations(spark, d):
    f, model = _logreg_model(spark, d)
    out = CL.score_equations(f.where(F.col("split") == "train"), model, SUB_RATINGS, "label", 0.1)
    return out.select("equation", (F.abs("value") < 1e-4).alias("settled"))


@query("rating_weights")
def q_rating_weights(spark, d):
    _, model = _logreg_model(spark, d)
    return CL.logreg_weights(spark, model, SUB_RATINGS)


@query("ratings_random_forest")
def q_ratings_random_forest(spark, d):
    f, model = _forest_model(spark, d)
    return _classifier_report(f, model)


@query("rf_importances")
def q_rf_importances(spark, d):
    _, model = _forest_model(spark, d)
    return CL.forest_importances(spark, model, SUB_RATINGS)


def _stored_forest(spark, d):
    """Split ratings, the fitted forest and its node table, read from the stored model."""
    f, model = _forest_model(spark, d)
    version = save_model(spark, model, "ratings-forest")
    return f, model, forest_nodes(spark, model_path(spark, "ratings-forest", version), SUB_RATINGS)


@query("rf_trees")
def q_rf_trees(spark, d):
    return _stored_forest(spark, d)[2]


@query("rf_node_scores")
def q_rf_node_scores(spark, d):
    """Every rating scored by the stored node table."""
    f, _, nodes = _stored_forest(spark, d)
    return CL.forest_scores(f, nodes, SUB_RATINGS).select(
        "l_orderkey", "line", "split", "label", "forest_score", "forest_prediction")


@query("rf_gain_importances")
def q_rf_gain_importances(spark, d):
    return CL.gain_importances(_stored_forest(spark, d)[2], SUB_RATINGS)


@query("weight_lookup")
def q_weight_lookup(spark, d):
    _, model = _forest_model(spark, d)
    return CL.weight_lookup(CL.forest_importances(spark, model, SUB_RATINGS),
                            "p_retailprice")


@query("weight_display_names")
def q_weight_display_names(spark, d):
    _, model = _forest_model(spark, d)
    names = spark.createDataFrame(list(DISPLAY_NAMES.items()),
                                  "column string, display string")
    imp = CL.forest_importances(spark, model, SUB_RATINGS)
    return CL.with_display_names(imp, names).orderBy("weight", "column")


# --------------------------------------------------------- text models ----

def _review_features(spark, d, fit_on: str = "train"):
    """The vocabulary and cached (doc_id, source, quality, split, tfidf); ``fit_on`` = 'train' (default) or 'all' (reference's first
    model, whose vocabulary saw every review)."""
    rv = split.hash_split(V.reviews(spark, d), "doc_id").withColumn(
        "quality", F.col("quality").cast("double"))
    return TM.featurize(rv, "doc_id", "text", list(STOP_WORDS), ["doc_id", "source", "quality", "split"],
                        fit_filter=None if fit_on == "all" else F.col("split") == "train")


def _text_fit(spark, d, fit_on, reg, en):
    terms, feats = _review_features(spark, d, fit_on)
    lr = TM.logreg("quality", reg, en).fit(feats.where(F.col("split") == "train"))
    return terms, feats, lr


def _text_summary(spark, name, fit_on, reg, en, feats, lr):
    val = lr.transform(feats.where(F.col("split") == "validation"))
    acc = val.agg(F.avg(match_flag("prediction", "quality")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n_validation")).first()
    w = lr.coefficients.toArray()
    row = (name, fit_on, float(reg), float(en), acc["accuracy"],
           int(acc["n_validation"]), int(len(w)), int((w == 0).sum()))
    return spark.createDataFrame([row], (
        "model string, features_fit_on string, reg_param double, "
        "elastic_net_param double, accuracy double, n_validation long, "
        "n_words int, n_zero_weights int"))


@query("text_logreg")
def q_text_logreg(spark, d):
    _, feats, lr = _text_fit(spark, d, "all", 0.0, 0.0)
    out = _text_summary(spark, "logreg", "all", 0.0, 0.0, feats, lr)
    feats.unpersist()
    return out


@query("text_elastic_net")
def q_text_elastic_net(spark, d):
    _, feats, lr = _text_fit(spark, d, "train", 0.02, 0.3)
    out = _text_summary(spark, "elastic_net", "train", 0.02, 0.3, feats, lr)
    feats.unpersist()
    return out


def _elastic_net_weights(spark, d):
    terms, feats, lr = _text_fit(spark, d, "train", 0.02, 0.3)
    feats.unpersist()
    return TM.word_weights(terms, lr)


@query("word_weights")
def q_word_weights(spark, d):
    return _elastic_net_weights(spark, d)


@query("weight_sparsity")
def q_weight_sparsity(spark, d):
    return agg.zero_weight_summary(_elastic_net_weights(spark, d))


_PENALTY = 0.005
_MARGINAL_SQL = f"""{O.REVIEWS_CTE},
c AS (SELECT doc_id, quality, word, count(*) AS n
      FROM (SELECT doc_id, quality, unnest({_FILTERED}) AS word FROM reviews WHERE text IS NOT NULL) t
      GROUP BY doc_id, quality, word),
t AS (SELECT CAST(count(*) AS DOUBLE) AS r, CAST(sum(quality) AS DOUBLE) AS p FROM reviews WHERE text IS NOT NULL),
s AS (SELECT word, sum(n) AS x, sum(n * n) AS xx, sum(n * quality) AS xy FROM c GROUP BY word HAVING count(*) >= 5),
m AS (SELECT word, xy / r - x / r * (p / r) AS cov, xx / r - (x / r) * (x / r) AS var FROM s, t),
w AS (SELECT word, coalesce(CASE WHEN cov > {_PENALTY} THEN cov - {_PENALTY}
                                 WHEN cov < -{_PENALTY} THEN cov + {_PENALTY} ELSE 0.0 END / nullif(var, 0), 0.0) AS weight
      FROM m)"""


def _marginal_weights(spark, d):
    rv = V.reviews(spark, d).where(F.col("text").isNotNull())
    total = rv.agg(F.count(F.lit(1)).alias("r"), F.sum("quality").alias("p")).first()
    words = rv.select("doc_id", "quality", F.explode(text.without_stop_words(letter_tokens("text"), STOP_WORDS)).alias("word"))
    counts = words.groupBy("doc_id", "quality", "word").agg(F.count(F.lit(1)).alias("n"))
    return agg.marginal_lasso_weights(counts, "word", "n", "quality", total["r"], float(total["p"] or 0), _PENALTY, text.MIN_DF)


@query("marginal_weights", f"WITH {_MARGINAL_SQL} SELECT word, round(weight, 6) + 0.0 AS weight FROM w")
def q_marginal_weights(spark, d):
    return _marginal_weights(spark, d).select("word", r6("weight").alias("weight"))


@query("marginal_sparsity", f"""
WITH {_MARGINAL_SQL}
SELECT CAST(count(*) FILTER (weight = 0) AS BIGINT) AS n_zero, count(*) AS n_total,
       round(avg(CAST(weight = 0 AS DOUBLE)), 6) AS zero_share FROM w""")
def q_marginal_sparsity(spark, d):
    out = agg.zero_weight_summary(_marginal_weights(spark, d))
    return out.select("n_zero", "n_total", r6("zero_share").alias("zero_share"))


@query("marginal_zero_words", f"WITH {_MARGINAL_SQL} SELECT word FROM w WHERE weight = 0 ORDER BY word LIMIT 15")
def q_marginal_zero_words(spark, d):
    return agg.zero_weights(_marginal_weights(spark, d), "word", 15).select("word")


@query("zero_weight_words")
def q_zero_weight_words(spark, d):
    """The first words (the report's 15) that the elastic net leaves out."""
    return agg.zero_weights(_elastic_net_weights(spark, d), "word", 15)


@query("word_weight_extremes")
def q_word_weight_extremes(spark, d):
    return agg.top_bottom(_elastic_net_weights(spark, d), "weight", "word", 15)


def _grid(spark, d):
    _, feats = _review_features(spark, d, "train")
    res, models = TM.grid_search(
        spark, feats.where(F.col("split") == "train"),
        feats.where(F.col("split") == "validation"), "quality",
        REG_PARAMS, ELASTIC_NET_PARAMS)
    return feats, res, models


@query("grid_search")
def q_grid_search(spark, d):
    feats, res, _ = _grid(spark, d)
    best = agg.best_by(res, "accuracy", ["grid_index"]).select(
        F.col("grid_index").alias("_best"))
    out = res.join(F.broadcast(best), res.grid_index == best._best, "left") \
        .select(*res.columns, F.col("_best").isNotNull().alias("is_best"))
    return out


def _best_scored(spark, d):
    feats, res, models = _grid(spark, d)
    best_idx = agg.best_by(res, "accuracy", ["grid_index"]).first()["grid_index"]
    return models[best_idx].transform(feats)


@query("score_all")
def q_score_all(spark, d):
    return _best_scored(spark, d).select("doc_id", "source", "quality", "prediction")


@query("entity_report")
def q_entity_report(spark, d):
    return TM.entity_report(_best_scored(spark, d), "source",
                            BUSY_SOURCE_THRESHOLD)
