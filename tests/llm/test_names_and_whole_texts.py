"""Extra columns with any names, whole texts in fitting, and blocks of stored texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import bpe, language, quality, sharding, suffix_dedup

CLASHING = ["row", "_text", "_ll", "_post", "_prior", "_hh", "_hs", "_sum", "_host", "_path", "_h", "_p", "_suffix", "_declared",
            "_declared_l", "_suffix_l", "host_rate", "path_rate", "doc_p", "quality_p", "keep", "language", "language_p",
            "accepted", "good", "n", "h", "b", "slot", "shard", "rid", "block", "z", "size", "digest", "with space", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(2)
    words = {"en": "the and of tree runs water".split(), "de": "der und von baum läuft wasser".split()}
    rows = [(k, None if k == 3 else " ".join(rnd.choices(words[lang], k=30)), lang, f"s{k % 2}", k)
            for k, lang in enumerate(["en", "de"] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def test_clashing_names(spark, docs):
    model = language.fit_text(docs, "text", "lang")
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    got = language.identify(docs, model, "text", F.col("lang"), F.col("source"), F.col("source"))
    want = language.identify(plain, model, "text", F.col("lang"), F.col("source"), F.col("source"))
    rows = lambda df, cols: sorted(map(tuple, df.select(*[f"`{c}`" for c in cols]).collect()), key=str)
    assert rows(got, want.columns) == rows(want, want.columns)
    assert set(got.columns) == set(docs.columns) and rows(got, ["row", "a.b"]) == [("x", "x")] * 40
    assert language.keep_identified(docs, docs).columns == docs.columns

    classifier = quality.fit(plain, plain.select("doc_id", (F.col("doc_id") % 3 > 0).cast("int").alias("quality")))
    got = quality.score(docs, classifier, F.col("source"), F.col("lang"))
    want = quality.score(plain, classifier, F.col("source"), F.col("lang"))
    assert rows(got, want.columns) == rows(want, want.columns)

    table = sharding.lookup_table(spark)
    assert rows(sharding.place(docs, F.col("doc_id"), table), ["doc_id", "slot", "shard"]) \
        == rows(sharding.place(plain, F.col("doc_id"), table), ["doc_id", "slot", "shard"])
    assert sharding.place(docs.limit(0), F.col("doc_id"), table).count() == 0
    cut = suffix_dedup.cut_texts(docs)
    assert cut.columns == docs.columns and cut.count() == 40


def test_text_model_counts_whole_texts(spark):
    """The counts behind the model equal plain Python's over the whole of every distinct text."""
    texts = [("a", "x" * 10_000 + "only at the end"), ("a", "x" * 10_000 + "only at the end"), ("b", "short one"), ("b", "")]
    model = language.fit_text(spark.createDataFrame(texts, "lang string, text string"), "text", "lang")
    for k, lang in enumerate(model.langs):
        held = np.full(language.BUCKETS, 0.05)
        for t in {t for x, t in texts if x == lang}:
            raw = np.frombuffer(t.encode(), np.uint8)
            if len(raw) > 2:
                held += np.bincount(language.grams(raw), minlength=language.BUCKETS)
        assert np.allclose(model.logp[:, k], np.log(held / held.sum()), atol=1e-5)


def test_identify_equals_plain_python(spark):
    """Every row's posterior against the same evidence added up by hand."""
    rnd = random.Random(5)
    words = {"en": "the and of tree runs water".split(), "de": "der und von baum wasser ist".split(), "fr": "le et de arbre eau est".split()}
    rows = []
    for k in range(120):
        lang = rnd.choice(list(words))
        text = rnd.choice([None, "", "12 34", " ".join(rnd.choices(words[lang], k=rnd.randint(1, 12)))])
        rows.append((k, text, rnd.choice([lang, lang, None, "en"]), rnd.choice(["com", "de", None]), rnd.choice(["h1", "h2", "h3", None])))
    df = spark.createDataFrame(rows, "id long, text string, declared string, suffix string, host string")
    known = spark.createDataFrame([(lang, " ".join(rnd.choices(w, k=60))) for lang, w in words.items() for _ in range(5)], "lang string, text string")
    model = language.fit_text(known, "text", "lang")
    got = {r.id: r for r in language.identify(df, model, "text", F.col("declared"), F.col("suffix"), F.col("host")).collect()}

    n = len(model.langs)
    ll = {r[0]: language.TEMPER * model.loglik([r[1]])[0] for r in rows if any(c.isalpha() for c in r[1] or "")}
    post = {k: np.exp(v - v.max()) / np.exp(v - v.max()).sum() for k, v in ll.items()}
    mass = sum(post.values()) + 1 / n
    base = mass / mass.sum()
    seen = [r for r in rows if r[0] in post]

    def value_log(col, v):
        mine = [post[r[0]] for r in seen if r[col] == v]
        if v is None or not mine:
            return np.zeros(n)
        return np.log((sum(mine) + language.SMOOTH * len(mine) / len(seen)) / (mass + language.SMOOTH))

    def host_log(suffix, host):
        mine = [post[r[0]] for r in seen if r[4] == host and r[3] == suffix]
        if host is None or not mine:
            return np.log(base)
        around = [post[r[0]] for r in seen if r[4] is not None and r[3] == suffix]
        parent = (sum(around) + language.STRENGTH * base) / (len(around) + language.STRENGTH)
        return np.log((sum(mine) + language.STRENGTH * parent) / (len(mine) + language.STRENGTH))

    for k, _, declared, suffix, host in rows:
        total = ll.get(k, np.zeros(n)) + host_log(suffix, host) + value_log(2, declared) + value_log(3, suffix)
        p = np.exp(total - total.max()) / np.exp(total - total.max()).sum()
        assert got[k].language_p == pytest.approx(p.max(), abs=1e-9) and p[model.langs.index(got[k].language)] == pytest.approx(p.max())
        assert got[k].accepted == (k in ll and p.max() >= language.LEAST)


def test_quality_equals_plain_python(spark):
    """Site rates, prior weights and posteriors of every row against the formulas by hand."""
    rnd = random.Random(6)
    rows = [(k, rnd.choice(["good words in a row", "$$$ ||| 000", None, "Mixed 1 CASE"]) , rnd.choice(["h1", "h2", None]), rnd.choice(["p", "q"]))
            for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    weights = np.array([rnd.uniform(-3, 3) for _ in range(2 * len(quality.NAMES) + 1)])
    got = {r.doc_id: r for r in quality.score(df, weights, F.col("host"), F.col("path")).collect()}
    p = dict(zip([r[0] for r in rows], quality._probabilities([r[1] for r in rows], weights)))
    group = lambda key: {v: [p[r[0]] for r in rows if key(r) == v] for v in {key(r) for r in rows}}
    base = (sum(p.values()) + 1) / (len(p) + 2)

    def weight(groups, prior):
        spread = sum(len(g) * (np.mean(g) - prior(k)) ** 2 for k, g in groups.items())
        alone = sum(prior(k) * (1 - prior(k)) for k in groups)
        n = sum(map(len, groups.values()))
        within = sum(len(g) * prior(k) * (1 - prior(k)) for k, g in groups.items())
        return 1e4 if spread <= alone else float(np.clip(within / n / ((spread - alone) / n), 1, 1e4))

    hosts, paths = group(lambda r: r[2]), group(lambda r: (r[2], r[3]))
    w = weight(hosts, lambda k: base)
    host_rate = {k: (sum(g) + w * base) / (len(g) + w) for k, g in hosts.items()}
    w = weight(paths, lambda k: host_rate[k[0]])
    path_rate = {k: (sum(g) + w * host_rate[k[0]]) / (len(g) + w) for k, g in paths.items()}
    logit = lambda x: np.log(x / (1 - x))
    clip = lambda x: min(max(x, 1e-6), 1 - 1e-6)
    for k, _, host, path in rows:
        z = logit(clip(p[k])) + logit(clip(path_rate[host, path])) - logit(clip(base))
        r = got[k]
        assert (r.doc_p, r.host_rate, r.path_rate, r.quality_p) == pytest.approx((p[k], host_rate[host], path_rate[host, path], 1 / (1 + np.exp(-z))), abs=1e-9)
        assert r.keep == (r.quality_p >= quality.LEAST)


def test_blocks_are_cut_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1000)
    rows = [(k, "x" * n) for k, n in enumerate([400, 400, 400, 5000, 1, 1, 998, 2])]
    kept = suffix_dedup.stored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "text")
    blocks = {}
    for r in kept.collect():
        blocks.setdefault(r.block, []).append((r.doc_id, r.size))
        assert r.rid >> suffix_dedup.BLOCK_BITS == r.block
    assert sorted(sorted(k for k, _ in b) for b in blocks.values()) == [[0, 1], [2], [3], [4, 5, 6], [7]]
    texts = [(k, "same text of some length " * 12) for k in range(50)] + [(99, "x" + "same text of some length " * 12)]
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()}
    assert all(got[k].n_removed == got[k].n_bytes and got[k].n_spans == 1 for k in range(50)) and got[99].n_removed == 300


def test_encoding_is_the_same_in_small_blocks(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choices(["tree", "runs", "ü", "42,", "naïve.", "\x00"], k=60))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    many = bpe.encode_decode(df, block_bytes=200).collect()
    assert sorted(map(tuple, many)) == sorted(map(tuple, bpe.encode_decode(df).collect()))
