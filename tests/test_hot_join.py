"""Joins past the broadcast limit: frequent keys stay out of the shuffle, and no row is lost."""

import random
from collections import Counter
from statistics import median

import pytest
from pyspark.sql import functions as F

from opinio.operators.joins import frequent_keys, join_checked, split_hot_join
from opinio.plans import lexicon as lx

PARTITIONS = 16


@pytest.fixture(scope="module")
def zipf(spark):
    """60,000 rows over 20,000 words by Zipf's law, a third of them one word; some NULL."""
    rnd = random.Random(3)
    weights = [1 / (k + 1) for k in range(20_000)]
    words = [f"w{k}" for k in rnd.choices(range(20_000), weights, k=40_000)] + ["hot"] * 20_000 + [None] * 500
    rnd.shuffle(words)
    big = spark.createDataFrame(list(enumerate(words)), "id long, word string").repartition(6)
    small = spark.createDataFrame([(f"w{k}", k) for k in range(0, 20_000, 2)] + [("hot", -1), ("w2", 7), (None, 0)], "word string, s long")
    return words, big.cache(), small


def test_frequent_keys_are_all_found(spark, zipf):
    words, big, _ = zipf
    found = {r.word for r in frequent_keys(big, "word", PARTITIONS).collect()}
    share = len(words) / PARTITIONS / 4
    counts = Counter(w for w in words if w is not None)
    assert {w for w, n in counts.items() if n > share} <= found
    assert len(found) <= 4 * PARTITIONS
    assert all(counts[w] > share / 2 for w in found)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(spark, zipf, how):
    _, big, small = zipf
    rows = lambda df: Counter(map(tuple, df.select(sorted(df.columns)).collect()))
    want = rows(big.join(small, "word", how))
    assert rows(split_hot_join(big, small, "word", how, partitions=PARTITIONS)) == want
    assert rows(join_checked(big, small, "word", how, max_broadcast_rows=1)) == want
    # the frequent keys' own rows do not fit: one shuffle join
    assert rows(split_hot_join(big, small, "word", how, max_broadcast_rows=0, partitions=PARTITIONS)) == want


def test_no_task_gets_many_times_the_median(spark, zipf):
    _, big, _ = zipf
    rest = big.where("word is not null").join(F.broadcast(frequent_keys(big, "word", PARTITIONS)), "word", "left_anti")
    task = lambda df: [r["count"] for r in df.repartition(PARTITIONS, "word").groupBy(F.spark_partition_id()).count().collect()]
    sizes = task(rest)
    assert len(sizes) == PARTITIONS and max(sizes) <= 5 * median(sizes)
    whole = task(big)
    assert max(whole) > 5 * median(whole)  # without the split one task would


def test_empty_sides(spark, zipf):
    _, big, small = zipf
    assert split_hot_join(big.limit(0), small, "word").count() == 0
    assert split_hot_join(big, small.limit(0), "word").count() == 0
    assert split_hot_join(big, small.limit(0), "word", "left").count() == big.count()


def test_sentiment_past_the_limit(spark):
    """A frequent word in every text, an unscored one, a word without a score, an entity of a third of all rows."""
    rnd = random.Random(5)
    texts = [("big" if i % 3 == 0 else f"e{i % 50}", "the " * 5 + " ".join(rnd.choices(["good", "bad", "odd", "none", f"x{'abcdefgh'[i % 8]}"], k=4)))
             for i in range(900)] + [("big", None), ("quiet", "nothing known"), ("nulls", "none")]
    df = spark.createDataFrame(texts, "e string, t string").repartition(5)
    lex = spark.createDataFrame([("the", 1), ("good", 1), ("bad", -3), ("none", None), ("xa", 2)], "word string, sentiment int")
    rows = lambda out: {r.e: (r.avg_sentiment, r.predicted) for r in out.collect()}
    near, far = rows(lx.entity_sentiment(df, "e", "t", lex)), rows(lx.entity_sentiment(df, "e", "t", lex, 0))
    assert near.keys() == far.keys() and "quiet" not in far and far["nulls"][0] is None
    assert all(far[e][0] == pytest.approx(near[e][0]) and far[e][1] == near[e][1] for e in near)
    cover = lambda n: sorted(map(tuple, lx.lexicon_coverage(df, "e", "t", lex, n).collect()))
    assert cover(0) == cover(100)
