"""Synthetic stand-ins for the review inputs, derived from the test tables.

* ``reviews``  = documents JOIN labels USING (doc_id): entity ``source``,
  text ``text``, label ``quality``.
* ``docs``     = documents alone (text operators needing no label).
* ``ratings``  = lineitem JOIN orders JOIN part: entity ``l_suppkey``, eight
  numeric features (two with real NULLs), label from ``l_returnflag``
  (R -> 1, A -> 0, else NULL), split key ``l_orderkey``.
* ``lexicon``  = a deterministic word score derived from the md5 of each
  distinct letter token of ``documents``.

Every view is lazy: Catalyst prunes columns and pushes filters into the
parquet scans of whatever query uses it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.functions.columns import letter_tokens
from opinio.operators.partition import join_tasks
from opinio.operators.split import hash_split
from opinio.sources.readers import land, land_bucketed, read_parquet
from opinio.specs import ReviewSpec

# The eight numeric features of the ratings view.
RATING_FEATURES = (
    "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_linenumber", "o_totalprice", "p_size", "p_retailprice",
)

def _ols_runs(features: tuple[str, ...]) -> tuple:
    """What each column of the view adds: all columns, each left out, and the columns taken up one by one."""
    subsets = [features, *(tuple(f for f in features if f != out) for out in features),
               *(features[:k] for k in range(1, len(features)))]
    return tuple((subset, "train", "validation") for subset in dict.fromkeys(subsets))


RATING_OLS_RUNS = _ols_runs(RATING_FEATURES)

REVIEWS = ReviewSpec(entity_col="source", text_col="text",
                     label_col="quality", key_col="doc_id")
DOCS = ReviewSpec(entity_col="source", text_col="text",
                  label_col="quality", key_col="doc_id")
RATINGS = ReviewSpec(entity_col="l_suppkey", text_col="",
                     label_col="label", key_col="l_orderkey",
                     rating_cols=RATING_FEATURES, ols_runs=RATING_OLS_RUNS)


# row keys used to spread a table that arrives in too few splits
SPREAD_KEYS = {"documents": "doc_id", "lineitem": "l_orderkey",
               "events": "event_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str,
          spread_out: bool = True) -> DataFrame:
    return read_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"),
                        spread_out, SPREAD_KEYS.get(name))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels", spread_out=False).select("doc_id", "quality")
    return docs(spark, sf_dir).join(labels, "doc_id")


#: Parts (three numbers each) are broadcast, where the planner wants to, up to so many rows: every task holds the table.
MOST_PARTS_SENT = 2_000_000


def rating_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Tasks of the join of lineitem and orders (a count from the files' footers)."""
    return join_tasks(spark, table(spark, sf_dir, "lineitem", spread_out=False).count())


def ratings(spark: SparkSession, sf_dir: str,
            labelled_only: bool = True, bucketed: bool = False) -> DataFrame:
    """Numeric ratings table; with ``labelled_only`` the R/A filter is a
    plain predicate on ``l_returnflag`` and reaches the lineitem scan. With ``bucketed``, both tables that meet by
    order key are landed in buckets of it first, and the view's rows stay where they lie: neither the join nor what
    follows by order key shuffles.

    A large lineitem is dealt to as many tasks as its rows need (``rating_tasks``), so no task sorts more than its share; parts
    too many to broadcast are the hashed side of a shuffle join, which sorts nothing and lets AQE split frequent parts."""
    tasks = rating_tasks(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem", spread_out=not (bucketed or tasks)).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
    if labelled_only:
        li = li.where(F.col("l_returnflag").isin("R", "A"))
    # dimension sides: joined as they are scanned (broadcast when their size
    # allows it, else shuffled by key) -- no redistribution of their own
    orders = table(spark, sf_dir, "orders", spread_out=False).select(
        "o_orderkey", "o_totalprice")
    if bucketed:
        li = land_bucketed(li, "lineitem", "l_orderkey", tasks)
        orders = land_bucketed(orders, "orders", "o_orderkey", tasks).hint("merge")
    part = table(spark, sf_dir, "part", spread_out=False).select(
        "p_partkey", "p_size", "p_retailprice")
    if tasks and part.count() > MOST_PARTS_SENT:
        part = part.hint("shuffle_hash")
    if tasks and not bucketed:  # parts first: the rows end up dealt by order key
        joined = (li.join(part, F.col("l_partkey") == F.col("p_partkey")).repartition(tasks, "l_orderkey")
                  .join(orders.repartition(tasks, "o_orderkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")))
    else:
        joined = (li.join(orders, li.l_orderkey == orders.o_orderkey)
                  .join(part, li.l_partkey == part.p_partkey))
    label = (F.when(F.col("l_returnflag") == "R", F.lit(1))
             .when(F.col("l_returnflag") == "A", F.lit(0)))
    return joined.select(
        "l_orderkey", F.col("l_linenumber").alias("line"), "l_suppkey",
        F.col("l_quantity").cast("double").alias("l_quantity"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"),
        F.col("l_linenumber").cast("double").alias("l_linenumber"),
        F.col("o_totalprice").cast("double").alias("o_totalprice"),
        F.col("p_size").cast("double").alias("p_size"),
        F.col("p_retailprice").cast("double").alias("p_retailprice"),
        label.cast("int").alias("label"),
    )


def ratings_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled ratings tagged train / validation / test by order key."""
    return hash_split(ratings(spark, sf_dir), "l_orderkey")


def landed_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ratings_split`` written once, in buckets of the order key and sorted by it: means, fits and scores
    read this copy, and nothing by order key shuffles any more."""
    view = hash_split(ratings(spark, sf_dir), "l_orderkey")
    return land_bucketed(view, "ratings", "l_orderkey", rating_tasks(spark, sf_dir))


def reviews_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(reviews(spark, sf_dir), "doc_id")


def lexicon(spark: SparkSession, sf_dir: str, materialize: bool = True) -> DataFrame:
    """``(word, sentiment)``: a quarter of the distinct letter tokens of the
    corpus, scored +1 / -1 from their md5.

    A lexicon is an input table; this stand-in is derived from the corpus,
    so it is materialised once (a table in the shared folder):
    its size check and its join then read the written copy instead of
    re-tokenising the corpus."""
    words = docs(spark, sf_dir).select(
        F.explode(letter_tokens("text")).alias("word")).distinct()
    h = F.md5(F.col("word"))
    lex = (words.where(F.substring(h, 2, 1).isin("0", "1", "2", "3"))
            .select("word",
                    F.when(F.ascii(F.substring(h, 1, 1)) < 56, F.lit(1))
                    .otherwise(F.lit(-1)).alias("sentiment")))
    if materialize:
        lex = land(lex, "lexicon")
    return lex
