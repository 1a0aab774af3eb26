"""Physical-plan checks: the plans we want at scale stay the plans we get."""

from conftest import SF_SMALL
from opinio.catalog import QUERIES


def _formatted(spark, df) -> str:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_lexicon_plan_prunes_and_broadcasts(spark):
    text = _formatted(spark, QUERIES["lexicon_entity_sentiment"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in text
    assert "partial_avg" in text  # map-side partial aggregation per entity


def test_tokeniser_runs_once(spark):
    text = _formatted(spark, QUERIES["term_counts"](spark, SF_SMALL))
    # one tokeniser expression in the executed plan (no inferred size filter
    # re-running it before the redistribution)
    assert text.count("split(regexp_replace(lower(text") == 1
    assert "partial_count" in text


def test_label_filter_reaches_scan(spark):
    text = _formatted(spark, QUERIES["hash_split"](spark, SF_SMALL))
    assert "PushedFilters: [In(l_returnflag, [A,R])" in text
    assert "l_comment" not in text and "l_shipdate" not in text


def test_tfidf_broadcasts_bounded_idf(spark):
    text = _formatted(spark, QUERIES["tfidf"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text
    # the vocabulary is small at this scale: no global top-N sort
    assert "TakeOrderedAndProject" not in text
