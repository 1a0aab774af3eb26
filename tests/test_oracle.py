"""Every registered query with a SQL form equals its DuckDB oracle
(sf0.001 here; the driver repeats this at sf0.01)."""

import math

import pytest

from conftest import SF_SMALL
from opinio.catalog import ORACLE, QUERIES


def _rows(pdf):
    import pandas as pd

    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or v is pd.NA:
            return None
        if isinstance(v, float) and math.isnan(v):
            return None
        return v.item() if hasattr(v, "item") else v

    rows = [tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows, key=repr)


def test_every_query_registered_with_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 60


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    spark_pdf = QUERIES[name](spark, SF_SMALL).toPandas()
    duck_pdf = duck.execute(ORACLE[name]).fetchdf()
    sc, sr = _rows(spark_pdf)
    dc, dr = _rows(duck_pdf)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
