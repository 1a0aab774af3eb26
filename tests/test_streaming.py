"""The lexicon scorer on a streaming source equals the batch result."""

import os


from conftest import SF_SMALL
from opinio.plans import lexicon as lx
from opinio.plans import views as V
from opinio.session import scratch_path
from opinio.streaming import entity_sentiment_stream, run_to_memory


def test_stream_equals_batch(spark):
    docs = V.docs(spark, SF_SMALL).select("doc_id", "source", "text")
    folder = scratch_path(spark, "stream-in")
    docs.repartition(4).write.parquet(folder)
    stream_src = (spark.readStream.schema(docs.schema)
                  .option("maxFilesPerTrigger", 1).parquet(folder))
    lex = V.lexicon(spark, SF_SMALL)
    q = run_to_memory(spark, entity_sentiment_stream(stream_src, "source", "text", lex),
                      "lexicon_stream_test")
    try:
        got = {r.source: (round(r.avg_sentiment, 9), r.predicted)
               for r in spark.sql("SELECT * FROM lexicon_stream_test").collect()}
    finally:
        q.stop()
    want = {r.source: (round(r.avg_sentiment, 9), r.predicted)
            for r in lx.entity_sentiment(docs, "source", "text", lex).collect()}
    assert got == want and os.path.basename(folder)
