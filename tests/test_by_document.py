"""TF-IDF shuffles texts by document, not their words as rows: tables of more files than cores, with repeated and NULL ids."""

import math
import re
from collections import Counter

import pytest

from opinio.catalog import QUERIES, STOP_WORDS
from opinio.operators import text
from opinio.session import scratch_path
from opinio.sources import readers


@pytest.fixture(scope="module")
def folder(spark):
    d = scratch_path(spark, "few-documents")
    rows = [(k % 45 if k % 10 else None, f"alpha w{k % 4} w{k % 7} Beta beta" if k % 6 else (None if k % 4 else "")) for k in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(24).write.parquet(f"{d}/documents.parquet")
    return d, rows


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _wanted(rows):
    counts = Counter((i, w) for i, t in rows if t for w in re.findall("[a-z]+", t.lower()) if w not in STOP_WORDS)
    df = Counter(w for _, w in counts)
    n = sum(t is not None for _, t in rows)
    return {(i, w): round(c * math.log((n + 1) / (df[w] + 1)), 6) for (i, w), c in counts.items() if df[w] >= 5}


def test_tfidf_shuffles_no_words(spark, folder):
    d, rows = folder
    out = QUERIES["tfidf"](spark, d)
    assert "hashpartitioning(doc_id" not in _plan(out)
    got = [((r.doc_id, r.word), r.tfidf) for r in out.collect()]
    assert len(got) == len(dict(got)) and dict(got) == pytest.approx(_wanted(rows), abs=2e-6) and got


def test_vectors_are_gathered_where_they_lie(spark, folder, monkeypatch):
    d, rows = folder
    plans, real = [], readers.land_vectors
    monkeypatch.setattr(readers, "land_vectors", lambda df, *more: plans.append(_plan(df)) or real(df, *more))
    monkeypatch.setattr(text, "DOCS_A_TASK", 4, raising=False)  # more tasks than the session's number
    out = QUERIES["tfidf_vectors"](spark, d).collect()
    assert len(plans) == 1 and "hashpartitioning" not in plans[0]
    want = Counter()
    for (i, _), v in _wanted(rows).items():
        want[i, round(v, 4)] += 1
    assert Counter((r.doc_id, round(r.tfidf, 4)) for r in out if r.pos >= 0) == want
    assert {r.doc_id for r in out} == {i for i, t in rows if t is not None}
