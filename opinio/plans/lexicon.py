"""Lexicon sentiment.

Entity polarity = sign of the mean lexicon score over all word occurrences
of the entity's reviews; every review of the entity is then compared with
that one polarity.

Plan choice: when the lexicon is proven small (its count is checked) it is
broadcast and token rows stream through a map-side hash join straight into
a partial aggregate per entity -- a single, tiny shuffle. Otherwise
the frequent words, found by a sketch, meet a broadcast of their own rows of the lexicon, and the rest
is reduced to ``(entity, word, n)`` counts (map-side combine) before it is shuffled by word.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.functions.columns import letter_tokens, match_flag, polarity
from opinio.operators.joins import LEAST_TRACKED, frequent_keys, has_at_most, join_checked

MAX_BROADCAST_LEXICON_ROWS = 5_000_000


def entity_words(df: DataFrame, entity: str, text: str,
                 word: str = "word") -> DataFrame:
    """``(entity, word)`` per letter-token occurrence; NULL texts dropped."""
    return (df.where(F.col(text).isNotNull())
            .select(entity, F.explode(letter_tokens(text)).alias(word)))


def token_lexicon_join(words: DataFrame, lexicon: DataFrame,
                       max_broadcast_rows: int = MAX_BROADCAST_LEXICON_ROWS
                       ) -> DataFrame:
    """Inner join of token rows with the lexicon on ``word``: unknown words
    vanish."""
    return join_checked(words, lexicon.select("word", "sentiment"), "word",
                        "inner", max_broadcast_rows)


def entity_sentiment(df: DataFrame, entity: str, text: str,
                     lexicon: DataFrame,
                     max_broadcast_rows: int = MAX_BROADCAST_LEXICON_ROWS
                     ) -> DataFrame:
    """``(entity, avg_sentiment, predicted)``. Entities none of whose words
    are in the lexicon are absent; words without a score (NULL) count in
    neither the sum nor the divisor, whichever plan is chosen."""
    words = entity_words(df, entity, text)
    lex = lexicon.select("word", F.col("sentiment").cast("double").alias("s"))
    if has_at_most(lex, max_broadcast_rows):
        scored = (words.join(F.broadcast(lex), "word")
                  .groupBy(entity).agg(F.avg("s").alias("avg_sentiment")))
    else:
        # the sketch counts word occurrences; the shuffled rows are (entity, word), which are fewer
        hot_words = F.broadcast(frequent_keys(words, "word"))
        hot_lex = lex.join(hot_words, "word", "left_semi")
        parts = [F.sum("s").alias("_s"), F.count("s").alias("_n")]
        counted = [F.sum(F.col("s") * F.col("n")).alias("_s"),
                   F.sum(F.when(F.col("s").isNotNull(), F.col("n")).otherwise(0)).alias("_n")]
        if has_at_most(hot_lex, max(max_broadcast_rows, LEAST_TRACKED)):
            hot = words.join(hot_words, "word", "left_semi").join(F.broadcast(hot_lex), "word").groupBy(entity).agg(*parts)
            words = words.join(hot_words, "word", "left_anti")
        else:
            hot = None
        cold = (words.groupBy(entity, "word").agg(F.count(F.lit(1)).alias("n"))
                .join(lex, "word").groupBy(entity).agg(*counted))
        sums = cold if hot is None else hot.unionByName(cold)
        scored = sums.groupBy(entity).agg(
            F.try_divide(F.sum("_s"), F.sum("_n")).alias("avg_sentiment"))
    return scored.withColumn("predicted", polarity("avg_sentiment"))


def entity_prediction_join(df: DataFrame, entity: str,
                           predictions: DataFrame,
                           max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Attach each entity's prediction to its reviews (inner: reviews of
    entities without a prediction drop out). One row per entity on the
    small side, computed once (written to the checkpoint folder), broadcast
    when its count is checked."""
    return join_checked(df, predictions, entity, "inner", max_broadcast_rows,
                        materialize=True)


def lexicon_accuracy(df: DataFrame, entity: str, label: str,
                     predictions: DataFrame, by: list[str] | None = None
                     ) -> DataFrame:
    """Share of reviews whose label equals their entity's polarity."""
    joined = entity_prediction_join(df, entity, predictions.select(entity, "predicted"))
    flagged = joined.withColumn("correct", match_flag(label, "predicted"))
    if by:
        return flagged.groupBy(*by).agg(F.avg("correct").alias("accuracy"))
    return flagged.agg(F.avg("correct").alias("accuracy"))


def lexicon_coverage(df: DataFrame, entity: str, text: str, lexicon: DataFrame,
                     max_broadcast_rows: int = MAX_BROADCAST_LEXICON_ROWS
                     ) -> DataFrame:
    """Per entity: word occurrences, how many the lexicon scores, and the
    share -- the inner join of the polarity silently drops the rest, and an
    entity with coverage 0 has no polarity at all."""
    words = entity_words(df, entity, text)
    lex = lexicon.select("word", F.lit(1).alias("_hit"))
    # counted before the join, so a common word is one row per entity
    counts = words.groupBy(entity, "word").agg(F.count(F.lit(1)).alias("n"))
    joined = join_checked(counts, lex, "word", "left", max_broadcast_rows)
    scored = F.sum(F.when(F.col("_hit").isNotNull(), F.col("n")).otherwise(0))
    return joined.groupBy(entity).agg(
        F.sum("n").alias("n_words"), scored.alias("n_scored"),
        (scored.cast("double") / F.sum("n")).alias("coverage"))
