"""Hand-made cases with known answers (FIXTURES section 6)."""

import math
import os
import tempfile

import pytest

from opinio.functions.columns import (
    label_int,
    lenient_double,
    letter_tokens,
    whitespace_tokens,
)
from opinio.operators import aggregate as agg
from opinio.operators import clean, text
from opinio.plans import lexicon as lx
from opinio.plans import metrics as M
from opinio.sources import readers


def test_d1_malformed_rating(spark):
    df = spark.createDataFrame([("bad",), ("",), ("7",), ("5.0",)], "r string")
    got = [r[0] for r in df.select(lenient_double("r")).collect()]
    assert got == [None, None, 7.0, 5.0]


def test_d2_label_forms(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("0",), ("",), ("recommended",)],
                               "r string")
    got = [r[0] for r in df.select(label_int("r")).collect()]
    assert got == [1, 1, 0, None, None]


def test_d4_csv_quoting(spark):
    d = tempfile.mkdtemp(prefix="opinio-csv-")
    path = os.path.join(d, "reviews.csv")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('entity,content,recommended\n')
        fh.write('a,"say ""hi"" now",1\n')
        fh.write('b,"first line\nsecond line",0\n')
    df = readers.read_review_csv(spark, path, ["entity", "content", "recommended"])
    rows = {r.entity: r.content for r in df.collect()}
    assert rows == {"a": 'say "hi" now', "b": "first line\nsecond line"}


def test_positional_rename(spark):
    df = spark.createDataFrame([("x", "1")], "_c0 string, _c1 string")
    assert clean.rename_positional(df, ["name", "rating"]).columns == ["name", "rating"]
    with pytest.raises(ValueError):
        clean.rename_positional(df, ["only_one"])


def test_d5_label_filter(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (2,)], "y int")
    assert clean.labelled_only(df, "y").count() == 2
    assert sorted(r.y for r in clean.union_by_label(df, "y").collect()) == [0, 1]


def test_d8_fill(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (4.0,)], "x double")
    got = [r.x for r in clean.fill_constants(df, {"x": 9.0}).collect()]
    assert got == [9.0, 9.0, 4.0]


def test_d8_imputer_fit_on_train_only(spark):
    df = spark.createDataFrame(
        [("train", 1.0), ("train", 3.0), ("train", None), ("test", 100.0), ("test", None)],
        "split string, x double")
    out = clean.impute_mean(df.where("split = 'train'"), df, ["x"])
    got = sorted((r.split, r.x) for r in out.collect())
    assert got == [("test", 2.0), ("test", 100.0), ("train", 1.0), ("train", 2.0), ("train", 3.0)]


def test_d9_null_text(spark):
    df = spark.createDataFrame([("e", None), ("e", "good day")], "e string, t string")
    assert clean.drop_missing(df, ["t"]).count() == 1
    words = lx.entity_words(df, "e", "t").collect()
    assert [w.word for w in words] == ["good", "day"]


def test_d10_whitespace_tokens(spark):
    df = spark.createDataFrame([("Hello  World! It's 5",), ("a b  ",), ("   ",), ("",)],
                               "t string")
    got = [r[0] for r in df.select(whitespace_tokens("t")).collect()]
    assert got[0] == ["hello", "", "world!", "it's", "5"]
    # Tokenizer (java split) drops trailing empties; all-blank gives []
    assert got[1] == ["a", "b"]
    assert got[2] == []
    assert got[3] == [""]


def test_d10_matches_ml_tokenizer(spark):
    df = spark.createDataFrame([("Hello  World! It's 5",), ("a b  ",), ("   ",), (" x",)],
                               "t string")
    ml = text.ml_tokenizer("t", "ml", "whitespace").transform(df)
    for r in ml.select(whitespace_tokens("t").alias("sql"), "ml").collect():
        assert r.sql == r.ml


def test_d11_letter_tokens(spark):
    df = spark.createDataFrame([("Hello  World! It's 5 ÉTÉ-naïve",), ("123 !!",)], "t string")
    got = [r[0] for r in df.select(letter_tokens("t")).collect()]
    assert got == [["hello", "world", "it", "s", "été", "naïve"], []]


@pytest.fixture()
def lexicon_case(spark):
    lex = spark.createDataFrame([("good", 1), ("bad", -1)], "word string, sentiment int")
    reviews = spark.createDataFrame(
        [("A", "good good bad", 1), ("A", "", 0), ("B", "good bad", 0), ("C", "table", 1)],
        "e string, t string, y int")
    return lex, reviews


@pytest.mark.parametrize("max_rows", [1000, 0])  # broadcast path, shuffle path
def test_d12_d13_lexicon(spark, lexicon_case, max_rows):
    lex, reviews = lexicon_case
    got = {r.e: (round(r.avg_sentiment, 6), r.predicted)
           for r in lx.entity_sentiment(reviews, "e", "t", lex, max_rows).collect()}
    assert got == {"A": (0.333333, 1.0), "B": (0.0, 0.0)}


def test_d12_accuracy(spark, lexicon_case):
    lex, reviews = lexicon_case
    pred = lx.entity_sentiment(reviews, "e", "t", lex)
    acc = lx.lexicon_accuracy(reviews, "e", "y", pred).first().accuracy
    assert acc == pytest.approx(2 / 3)


def test_d14_document_frequency_and_idf(spark):
    rows = [(i, "keep") for i in range(5)] + [(i, "drop") for i in range(4)]
    counts = text.term_counts(spark.createDataFrame(rows, "doc int, word string"), "doc")
    vocab = text.vocabulary(counts)
    assert [r.word for r in vocab.collect()] == ["keep"]
    one = spark.createDataFrame([("w", 1)], "word string, doc_freq long")
    idf = text.idf_weights(one, 4).first().idf
    assert idf == pytest.approx(math.log(5 / 2))
    assert round(idf, 6) == 0.916291


def test_vocab_size_cut_is_deterministic(spark):
    rows = [(d, w) for d in range(5) for w in ("b", "a", "c")] + [(0, "c")]
    counts = text.term_counts(spark.createDataFrame(rows, "doc int, word string"), "doc")
    got = [(r.word, r.term_index) for r in text.vocabulary(counts, vocab_size=2).collect()]
    assert sorted(got, key=lambda x: x[1]) == [("c", 0), ("a", 1)]


def test_d19_argmax_ties(spark):
    df = spark.createDataFrame([(0, 0.7), (1, 0.9), (2, 0.9)], "i int, acc double")
    assert agg.best_by(df, "acc", ["i"]).first().i == 1


def test_d20_error_bar(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 0.0), ("x", 1.0), ("x", 0.0), ("y", 1.0)],
                               "e string, p double")
    got = {r.e: (r.prediction, r.err) for r in agg.mean_with_error(df, "e", "p").collect()}
    assert got["x"][0] == 0.5 and round(got["x"][1], 6) == 0.57735
    assert got["y"] == (1.0, None)


def test_e1_mse(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "prediction double, label double")
    assert M.mse(df).first().mse == 0.5


def test_e3_auc(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)], "s double, y int")
    assert M.area_under_roc(df, "s", "y").first().auc == pytest.approx(0.75)


def test_e3_auc_ties_and_buckets(spark):
    rows = [(float(i % 7), i % 3 == 0) for i in range(500)]
    df = spark.createDataFrame([(s, int(y)) for s, y in rows], "s double, y int")
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    exact = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    for b in (1, 3, 64):
        assert M.area_under_roc(df, "s", "y", rows_per_range=b).first().auc == pytest.approx(exact)


def test_g6_zero_weights(spark):
    w = spark.createDataFrame([("a", 0.0), ("b", 1.5), ("c", 0.0), ("d", -2.0)],
                              "word string, weight double")
    s = agg.zero_weight_summary(w).first()
    assert (s.n_zero, s.n_total, s.zero_share) == (2, 4, 0.5)
    assert [r.word for r in agg.zero_weights(w, "word", 15).collect()] == ["a", "c"]


def test_o2_top_bottom(spark):
    w = spark.createDataFrame([(c, float(i)) for i, c in enumerate("abcdefg")],
                              "word string, weight double")
    got = {(r.end, r.rank): r.word for r in agg.top_bottom(w, "weight", "word", 2).collect()}
    assert got == {("bottom", 1): "a", ("bottom", 2): "b", ("top", 1): "g", ("top", 2): "f"}


def test_p11_entity_subset(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "e string, v int")
    assert sorted(r.e for r in clean.entity_subset(df, "e", ["a", "c"]).collect()) == ["a", "c"]
    keys = spark.createDataFrame([("b",)], "e string")
    assert [r.e for r in clean.entity_subset(df, "e", keys).collect()] == ["b"]
    assert [r.e for r in clean.entity_subset(df, "e", keys, 0).collect()] == ["b"]


def test_g3_busy_entities(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",)], "e string")
    got = [(r.e, r.review_count) for r in agg.busy_entities(df, "e", 1).collect()]
    assert got == [("a", 3), ("b", 2)]


def test_s5_word_list(spark):
    d = tempfile.mkdtemp(prefix="opinio-words-")
    path = os.path.join(d, "stop.txt")
    with open(path, "w") as fh:
        fh.write("a about\n  above\tafter\n\nagain\n")
    got = [r.word for r in readers.read_word_list(spark, path).collect()]
    assert got == ["a", "about", "above", "after", "again"]
    assert sorted(readers.load_stop_words(spark, path)) == sorted(got)


def test_s6_csv_sink_roundtrip(spark):
    from opinio.session import scratch_path
    w = spark.createDataFrame([("x", 0.5), ("y, z", -1.25)], "column string, weight double")
    path = readers.write_csv(w, scratch_path(spark, "w"), single_file=True)
    back = readers.read_review_csv(spark, path, w.schema)
    assert sorted(back.collect()) == sorted(w.collect())


def test_vocab_cut_equals_full_sort(spark):
    """Threshold + tie fill gives exactly the top-N of a full sort."""
    import random
    rnd = random.Random(3)
    rows = []
    for w in range(400):
        docs = rnd.randint(1, 12)
        for d in range(docs):
            rows.append((d, f"w{w:03d}", rnd.choice([1, 1, 2, 3])))
    counts = spark.createDataFrame(rows, "doc int, word string, n long")
    for size in (1, 7, 50, 123, 399, 1000):
        got = [(r.word, r.term_index) for r in
               text.vocabulary(counts, min_df=2.0, vocab_size=size).collect()]
        stats = {}
        for d, w, n in rows:
            df_, tc = stats.get(w, (set(), 0))
            df_.add(d)
            stats[w] = (df_, tc + n)
        cand = sorted(((-tc, w) for w, (ds, tc) in stats.items() if len(ds) >= 2))
        want = [(w, i) for i, (_, w) in enumerate(cand[:size])]
        assert sorted(got, key=lambda x: x[1]) == want


def test_e3_auc_one_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "s double, y int")
    assert M.area_under_roc(df, "s", "y").first().auc is None


def test_d2_label_out_of_range_is_null(spark):
    df = spark.createDataFrame([("1e12",), ("-0.0",)], "r string")
    assert [r[0] for r in df.select(label_int("r")).collect()] == [None, 0]
