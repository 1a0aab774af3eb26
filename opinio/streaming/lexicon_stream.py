"""Incremental lexicon sentiment per entity over a stream of reviews.

Stream-static inner join of token rows with the lexicon (broadcast when
its count is checked), then a running aggregate of score sum and
word count per entity in the state store; polarity is derived from the
running mean. The state holds one row per entity, not per review.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from opinio.functions.columns import polarity
from opinio.operators.joins import maybe_broadcast
from opinio.plans.lexicon import MAX_BROADCAST_LEXICON_ROWS, entity_words
from opinio.session import scratch_path


def entity_sentiment_stream(reviews: DataFrame, entity: str, text: str,
                            lexicon: DataFrame,
                            max_broadcast_rows: int = MAX_BROADCAST_LEXICON_ROWS
                            ) -> DataFrame:
    """Streaming ``(entity, avg_sentiment, predicted)``; use output mode
    ``complete`` or ``update``."""
    lex = lexicon.select("word", F.col("sentiment").cast("double").alias("s"))
    words = entity_words(reviews, entity, text)
    joined = words.join(maybe_broadcast(lex, max_broadcast_rows), "word")
    sums = joined.groupBy(entity).agg(F.sum("s").alias("_sum"),
                                      F.count("s").alias("_n"))
    avg = (F.col("_sum") / F.col("_n")).alias("avg_sentiment")
    return sums.select(entity, avg).withColumn("predicted",
                                               polarity("avg_sentiment"))


def run_to_memory(spark: SparkSession, stream: DataFrame, name: str,
                  mode: str = "complete") -> StreamingQuery:
    """Run a streaming frame into a memory table until the source is
    drained (tests, notebooks); checkpoints go to the shared folder."""
    q = (stream.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", scratch_path(spark, f"stream-{name}"))
         .start())
    q.processAllAvailable()
    return q
