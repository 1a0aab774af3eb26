"""opinio: review analytics on Spark DataFrames.

Ratings + review text -> cleaned table -> features -> models -> metrics ->
ranked reports, expressed with the DataFrame / SQL API and Spark ML so that
Catalyst plans the work and nothing but bounded model parameters and final
reports reaches the driver.

Layout
------
sources/    readers and writers (CSV, parquet, stop-word text, CSV sink)
functions/  column expressions (lenient casts, tokenisers, hash buckets)
operators/  DataFrame -> DataFrame building blocks (clean, split, join,
            aggregate, text features)
plans/      composed analyses (lexicon sentiment, OLS subset report,
            classifiers, text models, entity reports, metrics)
streaming/  the lexicon scorer over a Structured Streaming source
"""

from opinio.specs import ReviewSpec

__all__ = ["ReviewSpec"]
