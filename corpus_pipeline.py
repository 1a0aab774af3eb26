"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept, and is
written as Parquet in the shared folder before the next one reads it. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from opinio.llm import language, ngram_join, packing, quality, suffix_dedup
from opinio.llm.common import land, recorded, remove_landed, table

_own: dict[str, list[str]] = {}  # stage -> the tables it wrote for itself


def after(before: str | None) -> Callable:
    """A stage's tables of its own go when the next stage (which names it) starts: by then its result is written. Tables that
    ``docs`` still reads stay."""
    def of(stage: Callable) -> Callable:
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            remove_landed(spark, _own.pop(before, []), docs)
            with recorded() as paths:
                out = stage(spark, docs, sf_dir)
            _own[stage.__name__] = paths
            return out
        return run_stage
    return of


@after(None)
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language cannot be told (no letter, or no language probable) go. NULL and empty texts hold no letter.
    Repeated rows are judged each; an empty table stays empty."""
    return language.keep_identified(docs, table(spark, sf_dir, "documents"))


@after("identify_language")
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose posterior of being good is below one half go. NULL and empty texts are judged by the shape of an
    empty text and their source; repeated rows are judged each; an empty table stays empty."""
    return quality.keep_good(docs, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@after("keep_quality")
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays. NULL, empty and other texts without words are copies of none; of
    repeated rows one stays; an empty table stays empty."""
    return ngram_join.drop_near_copies(docs)


@after("drop_near_copies")
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur again are cut out, at every place; rows with nothing left go. NULL and
    empty texts stay as they are; an empty table stays empty."""
    return suffix_dedup.cut_texts(docs)


@after("cut_repeats")
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens. NULL and empty texts give their closing id; an empty table no pieces."""
    return packing.pack_documents(docs)


STAGES = [
    ("language", identify_language),
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", pack),
]

#: Fitted classifiers and the tokeniser have no SQL form; tests/llm compares every stage with brute force or labels on
#: small planted tables, and the run with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = land(docs, f"pipeline-{name}")
    return docs
