"""Every pipeline stage on a small planted table: what goes, what stays, and what the texts are afterwards."""

import random
from collections import Counter

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def base(spark):
    """Clean rows of the given documents, one of each text, without whatever the stages would drop on their own."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    return docs.join(labels, "doc_id").where(F.length("text").between(300, 3000)).dropDuplicates(["text"]).select(docs.columns)


def made(spark, base, texts):
    """Rows like the base's first, with ids from 10^6 and the given texts."""
    one = base.limit(1)
    extra = spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(texts)], "id long, t string")
    return one.crossJoin(extra).select(*[F.col("id").cast(base.schema["doc_id"].dataType).alias("doc_id") if c == "doc_id" else
                                         F.col("t").alias("text") if c == "text" else F.col(c) for c in base.columns])


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def shingles(text):
    import re
    words = re.findall(r"\w+", (text or "").lower())
    return {tuple(words[k:k + 5]) for k in range(len(words) - 4)}


def test_language_drops_what_has_no_letters(spark, base):
    docs = base.union(made(spark, base, [None, "", "12 34 -- 56", "\n"]))
    got = STAGE["language"](spark, docs, SF)
    assert got.columns == docs.columns and all(k < 10**6 for k in ids(got))
    assert len(ids(got)) >= 0.98 * base.count()
    rows = lambda df: {tuple(r) for r in df.collect()}
    assert rows(got) <= rows(docs)


def test_quality_drops_junk(spark, base):
    mid = SF.replace("0.001", "0.01")  # enough labels of both kinds
    labels = spark.read.parquet(f"{mid}/labels.parquet")
    docs = spark.read.parquet(f"{mid}/documents.parquet")
    got = ids(STAGE["quality"](spark, docs, mid))
    marked = {r.doc_id: r.quality for r in labels.collect()}
    kept = {v: sum(1 for k in got if marked.get(k) == v) for v in (0, 1)}
    whole = Counter(marked.values())
    assert kept[1] >= 0.97 * whole[1] and kept[0] <= 0.5 * whole[0], (kept, whole)
    assert STAGE["quality"](spark, docs.union(made(spark, base, [None, ""])), SF).columns == docs.columns


def test_near_copies_leave_one_of_each_group(spark, base):
    rnd = random.Random(1)
    texts = [r.text for r in base.select("text").orderBy("doc_id").limit(6).collect()]
    near = []
    for t in texts[:4]:
        words = t.split(" ")
        words[rnd.randrange(len(words))] = "changed"
        near.append(" ".join(words))
    docs = base.union(made(spark, base, [*near, *texts[4:6], texts[4], "few words", "few words", None, "", ""]))
    got = STAGE["near_copies"](spark, docs, SF)
    text_of = {r.doc_id: r.text for r in docs.collect()}
    sets = {k: shingles(t) for k, t in text_of.items()}
    group = {k: k for k in text_of}

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    keys = sorted(text_of)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            same = text_of[a] == text_of[b] and sets[a]
            if same or (sets[a] and sets[b] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                group[root(b)] = root(a)
    kept = set(ids(got))
    with_words = {k for k in keys if sets[k]}
    assert len(kept & with_words) == len({root(k) for k in with_words})
    assert len({root(k) for k in kept & with_words}) == len(kept & with_words)
    assert {10**6 + 9, 10**6 + 10, 10**6 + 11} <= kept  # NULL and empty texts are copies of none


def test_repeats_are_cut_everywhere(spark, base):
    rnd = random.Random(2)
    passage = " ".join(f"w{rnd.randint(0, 9999)}" for _ in range(60))
    lone = [" ".join(f"{k}v{rnd.randint(0, 10**6)}" for _ in range(40)) for k in range(4)]
    texts = [f"{lone[0]} {passage} tail", f"{passage} {lone[1]}", lone[2], lone[2], None, "", lone[3]]
    docs = made(spark, base, texts)
    got = {r.doc_id - 10**6: r.text for r in STAGE["repeats"](spark, docs, SF).collect()}
    raw = [(t or "").encode() for t in texts]
    windows = Counter(r[k:k + 200] for r in raw for k in range(len(r) - 199))
    want = {}
    for k, r in enumerate(raw):
        gone = set()
        for lo in range(len(r) - 199):
            if windows[r[lo:lo + 200]] > 1:
                gone.update(range(lo, lo + 200))
        left = bytes(b for j, b in enumerate(r) if j not in gone).decode("utf-8", "ignore")
        if left or not r:
            want[k] = left if texts[k] is not None else None
    assert got == want and got[6] == lone[3] and passage not in got[0]


@pytest.mark.parametrize("name", list(STAGE))
def test_empty_tables(spark, base, name):
    assert STAGE[name](spark, base.limit(0), SF).count() == 0


def test_landed_tables_go_with_the_next_stage(spark, base, tmp_path):
    import glob

    folder = lambda: set(glob.glob("**/opinio-llm/*", root_dir=shared, recursive=True))
    from opinio.llm.common import shared_dir
    shared = shared_dir(spark).removeprefix("file:")
    STAGE["language"](spark, base, SF).write.parquet(str(tmp_path / "a"))
    held = {p for p in folder() if "language-" in p}
    assert held
    mine = set(corpus_pipeline._own["identify_language"])
    out = STAGE["quality"](spark, spark.read.parquet(str(tmp_path / "a")), SF)
    assert not any(p.rsplit("/", 1)[1] in q for p in mine for q in folder()) and out.count() > 0
    # a frame that still reads a landed table keeps it
    lazy = STAGE["language"](spark, base, SF)
    n = lazy.count()
    assert STAGE["quality"](spark, lazy, SF).count() <= n
