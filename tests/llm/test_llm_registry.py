"""The registry, the pipeline's stages and the SQL of the training-data operators."""

import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from opinio.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF).toPandas()
    cols = sorted(got.columns)
    rows = lambda f: sorted(map(tuple, f[cols].astype(object).to_numpy().tolist()))
    assert rows(got) == rows(con.sql(ORACLE[name]).df())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        after = docs.count()
        assert 0.5 * before < after <= before, name
        before = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    # where a document is cut depends on the partition it lies in; what is packed does not
    tokens = lambda df: sorted(map(tuple, df.groupBy("doc_id", "doc_tokens").agg(F.sum("length")).collect()))
    assert len(tokens(packed)) == before and all(n == total for _, n, total in tokens(packed))
    assert tokens(corpus_pipeline.run(spark, SF)) == tokens(packed)
