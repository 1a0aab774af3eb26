"""Driver contract: entry() runs on sf0.001; every query has a callable and
every oracle a query."""

import __spark_entry__ as entry


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "avg_sentiment", "predicted"]
    assert df.count() > 0


def test_contract_shapes():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and s.strip() for s in o.values())
    # the training-data queries are registered if and only if their package is there
    import importlib.util

    there = all(importlib.util.find_spec(m) for m in ("corpus_pipeline", "opinio.llm"))
    assert any(k.startswith("op") or k == "pipeline" for k in q) == there
