"""Text features (T1-T7, X1) in two equivalent forms.

Relational ("tall") form: tokens as SQL expressions, term counts as a
``(doc, word, n)`` DataFrame, vocabulary and IDF as aggregates. Everything
stays in whole-stage codegen; the vocabulary is a DataFrame, not a driver
list.

ML form: the ``Tokenizer`` / ``RegexTokenizer`` / ``StopWordsRemover`` /
``CountVectorizer`` / ``IDF`` stages, for model pipelines that need vectors.
Tests check both forms give the same numbers.
"""

from __future__ import annotations

from typing import Iterable

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.functions.columns import letter_tokens, whitespace_tokens

VOCAB_SIZE = 1 << 17
MIN_DF = 5.0


# --------------------------------------------------------------- tokens ----

def tokenize(df: DataFrame, text: str, out: str = "words",
             mode: str = "letters") -> DataFrame:
    """Add a token array: ``letters`` (runs of letters, lower-cased) or
    ``whitespace`` (lower-case, split on single whitespace)."""
    expr = letter_tokens(text) if mode == "letters" else whitespace_tokens(text)
    return df.withColumn(out, expr)


def explode_tokens(df: DataFrame, keep: list[str],
                   tokens: str | Column = "words", out: str = "word",
                   with_pos: bool = False) -> DataFrame:
    """One row per token; empty arrays produce no rows.

    Pass the token *expression* (``letter_tokens(...)``) rather than a
    column holding it: for an exploded column Catalyst infers a
    ``size(tokens) > 0`` filter and pushes it below the projection, so the
    tokeniser would run twice -- once before any redistribution of the
    scan. An exploded expression gets no inferred filter."""
    if with_pos:
        return df.select(*keep, F.posexplode(tokens).alias("pos", out))
    return df.select(*keep, F.explode(tokens).alias(out))


def without_stop_words(tokens: Column, stop_words: Iterable[str]) -> Column:
    """Token array minus stop words, case-insensitive (an InSet probe per
    token; the list is a bounded parameter)."""
    stops = sorted({w.lower() for w in stop_words})
    return F.filter(tokens, lambda w: ~F.lower(w).isin(stops))


def remove_stop_words(df: DataFrame, tokens: str, out: str,
                      stop_words: Iterable[str]) -> DataFrame:
    """Array-column form of ``without_stop_words``."""
    return df.withColumn(out, without_stop_words(F.col(tokens), stop_words))


def drop_stop_word_rows(words: DataFrame, stop_words: Iterable[str],
                        word: str = "word") -> DataFrame:
    """Tall form: drop token rows that are stop words."""
    stops = sorted({w.lower() for w in stop_words})
    return words.where(~F.lower(F.col(word)).isin(stops))


# ---------------------------------------------------------- term counts ----

def term_counts(words: DataFrame, doc: str, word: str = "word",
                out: str = "n") -> DataFrame:
    """``(doc, word, n)``: occurrences of each word in each document."""
    return words.groupBy(doc, word).agg(F.count(F.lit(1)).alias(out))


DOCS_A_TASK, MOST_TASKS = 4_000, 100_000


def by_document(df: DataFrame, doc: str, n_rows: int) -> tuple[DataFrame, int]:
    """The texts dealt by ``doc``, DOCS_A_TASK to a task (the session's number of tasks at least), and that number. What follows
    by document, or by document and word, shuffles nothing more: a text is many times smaller than its words as rows."""
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_TASKS, -(-n_rows // DOCS_A_TASK)))
    return df.repartition(tasks, doc), tasks


def vocabulary(counts: DataFrame, word: str = "word", n: str = "n",
               min_df: float = MIN_DF, vocab_size: int | None = None,
               n_docs: int | None = None, indexed: bool = True,
               rows_per_range: int = 100_000) -> DataFrame:
    """Words with document frequency >= minDF (a fraction of ``n_docs`` when
    < 1): ``(word, doc_freq, term_count)`` and, when ``indexed``,
    ``term_index`` (rank by total count, ties by word). With ``vocab_size``
    only that many most frequent words stay, as in ``CountVectorizer``.

    ``counts`` is the ``(doc, word, n)`` table, so one row per document
    per word: a word in a third of all documents is a partial-aggregated
    group, not a skewed task.

    No global sort: the words are counted once and landed, cut into ranges of (count, word) of bounded size,
    and ranked inside their range (``aggregate.ranks``); words of one count, however many,
    are spread over several ranges.
    """
    from opinio.operators.aggregate import ranks

    stats = counts.groupBy(word).agg(
        F.count(F.lit(1)).alias("doc_freq"),
        F.sum(n).cast("bigint").alias("term_count"))
    threshold = min_df if min_df >= 1.0 else min_df * float(n_docs or 0)
    kept = stats.where(F.col("doc_freq") >= F.lit(threshold))
    if not indexed and vocab_size is None:
        return kept
    ranked = ranks(kept, [F.desc("term_count"), F.asc(word)], "term_index", rows_per_range)
    return ranked if vocab_size is None else ranked.where(F.col("term_index") < vocab_size)


def idf_weights(vocab: DataFrame, n_docs, word: str = "word") -> DataFrame:
    """``log((N + 1) / (df + 1))`` per vocabulary word (Spark IDF)."""
    n = n_docs if hasattr(n_docs, "_jc") else F.lit(n_docs)
    return vocab.select(
        word, "doc_freq",
        F.log((n + F.lit(1.0)) / (F.col("doc_freq") + F.lit(1.0))).alias("idf"))


def tfidf(counts: DataFrame, idf: DataFrame, doc: str, word: str = "word",
          n: str = "n") -> DataFrame:
    """``(doc, word, tfidf)`` for vocabulary words; ``idf`` is broadcast while its checked size allows it, so that the
    counts stay where they are."""
    from opinio.operators.joins import join_checked

    return (join_checked(counts, idf.select(word, "idf"), word)
            .select(doc, word, (F.col(n) * F.col("idf")).alias("tfidf")))


# ------------------------------------------------------------- ML form ----

def ml_tokenizer(text: str, out: str = "words", mode: str = "letters"):
    if mode == "letters":
        return (RegexTokenizer().setGaps(False).setPattern(r"\p{L}+")
                .setInputCol(text).setOutputCol(out))
    return Tokenizer().setInputCol(text).setOutputCol(out)


def tfidf_estimator(text: str, stop_words: list[str],
                    vocab_size: int = VOCAB_SIZE, min_df: float = MIN_DF,
                    out: str = "tfidf") -> Pipeline:
    """Letter tokens -> stop words -> pruned counts -> IDF."""
    return Pipeline(stages=[
        ml_tokenizer(text, "words", "letters"),
        StopWordsRemover(stopWords=list(stop_words), caseSensitive=False,
                         inputCol="words", outputCol="filtered"),
        CountVectorizer(minTF=1.0, minDF=min_df, vocabSize=vocab_size,
                        inputCol="filtered", outputCol="tf"),
        IDF(inputCol="tf", outputCol=out),
    ])


def words_of_vectors(df: DataFrame, model, keep: list[str], vector: str = "tfidf") -> DataFrame:
    """Sparse vectors as rows ``keep + (word, <vector>)``, by the vocabulary of the fitted pipeline
    ``model`` (a bounded list)."""
    import pandas as pd

    from opinio.operators.joins import join_checked

    parts = F.unwrap_udt(vector)
    pairs = F.explode(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("v")))
    known = fitted_vocabulary(model)
    words = df.sparkSession.createDataFrame(pd.DataFrame({"i": range(len(known)), "word": known}), "i int, word string")
    rows = df.select(*keep, pairs.alias("_p")).select(*keep, F.col("_p.i").alias("i"), F.col("_p.v").alias(vector))
    return join_checked(rows, words, "i").select(*keep, "word", vector)


def sparse_vectors(entries: DataFrame, doc: str, index: str, value: str, size: int, out: str) -> DataFrame:
    """``(doc, out)``: one sparse ML vector of ``size`` entries per document, from rows ``(doc, index, value)``; a row
    without index adds nothing but keeps its document, so a document can have an empty vector.

    Each document's entries are gathered (bounded by its distinct words) and sorted by index in the JVM.
    The struct is landed and read back with the vector type, which has the same layout on disk: no Python
    and no vocabulary array on any machine."""
    from opinio.sources.readers import land_vectors

    pair = F.when(F.col(index).isNotNull(), F.struct(F.col(index).cast("int").alias("i"), F.col(value).cast("double").alias("v")))
    rows = entries.groupBy(doc).agg(F.sort_array(F.collect_list(pair)).alias("_e"))
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"),
                      F.col("_e.i").alias("indices"), F.col("_e.v").alias("values"))
    return land_vectors(rows.select(doc, vector.alias(out)), out)


def fitted_vocabulary(model) -> list[str]:
    """Vocabulary of the CountVectorizer inside a fitted TF-IDF pipeline
    (bounded by vocabSize)."""
    from pyspark.ml.feature import CountVectorizerModel
    for stage in _walk(model):
        if isinstance(stage, CountVectorizerModel):
            return list(stage.vocabulary)
    raise ValueError("no CountVectorizerModel in the pipeline")


def _walk(model):
    for st in getattr(model, "stages", []):
        if hasattr(st, "stages"):
            yield from _walk(st)
        else:
            yield st
