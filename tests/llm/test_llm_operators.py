"""The training-data operators against brute force on small tables that hold
NULLs, empty and long texts, ties, repeated rows and clashing extra columns."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinio.llm import (ann, bpe, components, embed_dedup, language, ngram_join, packing, quality, sharding, suffix_dedup,
                        tokens, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, z string, rid long, t string"


def _words(rnd, n):
    return " ".join(rnd.choice(["the", "and", "of", "tree", "runs", "über", "maß", "naïve", "x1", "42,", "end."])
                    + (str(rnd.randint(0, 400)) if rnd.random() < 0.7 else "") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(3)
    base = [_words(rnd, rnd.randint(1, 120)) for _ in range(40)]
    passage = _words(rnd, 70)
    out = base + base[:6] + [None, "", " ", "one", "two words", "a" * 700, "ab" * 400, "<|endoftext|> tail", "sp  ace\n\nx !!,."]
    for b in base[6:14]:
        w = b.split(" ")
        if len(w) > 20:
            w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    out += [b + " " + passage + " " + _words(rnd, 10) for b in base[14:20]]
    return out + [_words(rnd, 9000)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k if k != 5 else None, t, "en", f"s{k % 3}" if k % 5 else None, len(t or ""), "z", k, "t")
            for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = dict(map(tuple, components.connected_components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()))
    assert got == {k: 0 for k in range(31)} | {100: 100, 101: 100}


# ---- 1: embeddings

def _emb(spark, n=300, dim=16):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((n, dim))
    for k in range(0, 60, 3):
        x[k + 1] = x[k] + 0.02 * rng.standard_normal(dim)
        x[k + 2] = 3 * x[k]
    rows = [(k, [float(v) for v in x[k]]) for k in range(n)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, None), (n + 3, []), (n + 4, [0.0] * dim),
             (n + 5, [float("nan")] * dim), (n + 6, [None] * dim), (n + 7, [1.0, 2.0]), (n + 8, [float("inf")] * dim)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))


def test_embedding_links_equal_brute_force(spark):
    df = _emb(spark)
    got = {r.vec_id: r for r in embed_dedup.embedding_links(df, block_rows=2).collect()}
    rows = {r.vec_id: r.embedding for r in df.collect()}
    good = {k: np.array(v) for k, v in rows.items() if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = {k: set() for k in rows}
    for a in good:
        for b in good:
            if a != b and len(good[a]) == len(good[b]) and \
                    good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95:
                links[a].add(b)
    assert {k: r.n_links for k, r in got.items()} == {k: len(v) for k, v in links.items()}
    for k, r in got.items():
        seen, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        assert r.component_id == min(seen) and r.kept == (k == min(seen))
    assert embed_dedup.embedding_links(df.limit(0)).count() == 0


def _planted(n, pairs, dim=64):
    """A hot topic: ``n`` vectors of mutual cosine about 0.8, and ``pairs`` of them again at cosine just above 0.95."""
    rng = np.random.default_rng(9)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    side = unit(rng.standard_normal((n, dim - 1)))
    x = np.hstack([np.full((n, 1), 0.8 ** 0.5), 0.2 ** 0.5 * side])
    off = rng.standard_normal((pairs, dim))
    off = unit(off - (off * x[:pairs]).sum(1, keepdims=True) * x[:pairs])
    c = rng.uniform(0.951, 0.955, (pairs, 1))
    return np.vstack([x, c * x[:pairs] + (1 - c * c) ** 0.5 * off])


@pytest.mark.parametrize("wide", [embed_dedup.WIDE, 36])  # the second: rounds among those left before all pairs
def test_embedding_links_in_a_dense_cluster(spark, monkeypatch, wide):
    monkeypatch.setattr(embed_dedup, "WIDE", wide)
    n, pairs = 6000, 500
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(_planted(n, pairs))], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embed_dedup.embedding_links(df).collect()}
    assert len(got) == n + pairs
    met = sum(got[n + k].component_id == got[k].component_id and got[k].n_links >= 1 for k in range(pairs))
    assert met >= 0.995 * pairs


def test_embedding_links_of_the_passes_alone(spark, monkeypatch):
    """Without the exact rest: hardly a link is lost, and none is made up."""
    monkeypatch.setattr(embed_dedup, "all_pairs", lambda left, *a: left.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0))
    rng = np.random.default_rng(21)
    x = rng.standard_normal((700, 48))
    x[500:] = x[:200] + 0.2 * rng.standard_normal((200, 48))  # cosine about 0.98
    u = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32).astype(np.float64)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(u)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in embed_dedup.embedding_links(df).collect()}
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95) & ~np.eye(700, dtype=bool)
    met = [k for k in range(500, 700) if got[k].component_id == k - 500]
    assert len(met) >= 198
    for k in range(700):
        assert got[k].n_links == links[k].sum() or got[k].n_links == 0
        assert got[k].component_id == k or links[k, got[k].component_id]


def test_passes_grow_with_the_table():
    passes = [embed_dedup.first_passes(n, 0.95, 32, 1e-3) for n in (10, 50_000, 1_000_000, 100_000_000)]
    assert passes == [1, 18, 31, 66]


def test_spanning_links_join_the_same_rows():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 400, (2, 250))
    i, j = embed_dedup.spanning(400, a, b)

    def parts(links):
        low = list(range(400))
        for x, y in list(links) * 400:
            low[x] = low[y] = min(low[x], low[y])
        return low

    assert len(i) < 400 and parts(zip(a.tolist(), b.tolist())) == parts(zip(i.tolist(), j.tolist()))


# ---- 2, 8: tokens

def test_packing_covers_every_id_once(docs, texts, empty):
    tok = tokens.tokenizer(tokens.default_path())
    got = packing.pack_documents(docs.withColumn("tier", F.lit("x")), tiers=(64, 128, 256), step_tokens=1024).toPandas()
    want = {k: np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for k, t in enumerate(texts)}
    for k, g in got[got.doc_id.notna()].groupby("doc_id"):
        copies = 2 if k == len(texts) - 1 else 1
        ids = want[k]
        assert g.length.sum() == copies * len(ids) and set(g.doc_tokens) == {len(ids)}
        for r in g.itertuples():
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    s = got.sort_values(["sequence_id", "offset"])
    assert ((s.groupby("sequence_id").length.cumsum() - s.length) == s.offset).all()
    total = s.groupby("sequence_id").length.sum()
    assert ((total & (total - 1)) == 0).all() and total.max() <= 256
    assert s.groupby("step_group").length.sum().max() <= 1024
    assert packing.pack_documents(empty).count() == 0


def _signs():
    rnd = random.Random(11)
    near = ["word .", "word , next", "a ,b", " .", " ,", " , x", ". ,", "1 .5", "x .. y", "mot , suite . Fin !", "\n.x", "\t,", "\u00a0.",
            "it's , 's", "_ .", "\u00fc .\u00df", "<|endoftext|> . a", "a .<|endoftext|>, b"]
    return near + ["".join(rnd.choice(" .,!'_-\nab\u00e9Z90\t") for _ in range(rnd.randint(1, 30))) for _ in range(3000)]


def test_pieces_give_the_ids_of_the_whole_text():
    path = tokens.default_path()
    tok, held = tokens.tokenizer(path), tokens.PieceIds(path)
    for t in _signs():
        assert np.frombuffer(held.encode(t), "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_spaced_signs_in_both_token_queries(spark):
    path = tokens.default_path()
    tok, some = tokens.tokenizer(path), _signs()[:60]
    df = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string")
    coded = {r.doc_id: r for r in bpe.encode_decode(df, keep_ids=True).collect()}
    packed = {r.doc_id: r.doc_tokens for r in packing.pack_documents(df).collect()}
    for k, t in enumerate(some):
        ids = tok.encode(t, add_special_tokens=False).ids
        assert coded[k].ids == ids and coded[k].decoded == t and packed[k] == len(ids) + 1


def test_bpe_round_trip(docs, texts, empty):
    tok = tokens.tokenizer(tokens.default_path())
    for block in (bpe.BLOCK_BYTES, 2000):
        got = {r.doc_id: r for r in bpe.encode_decode(docs, block_bytes=block, keep_ids=True).collect()}
        for k, t in enumerate(texts):
            if k == 5:
                continue
            ids = tok.encode(t or "", add_special_tokens=False).ids
            r = got[k]
            assert r.n_tokens == len(ids) and r.ids == ids and r.decoded == (t or "")
            assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_decode(empty).count() == 0


# ---- 3: Jaccard join

def _sets(texts):
    out = []
    for t in texts:
        w = (t or "").lower().encode().split()
        n = min(5, len(w))
        out.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set())
    return out


def test_jaccard_links_equal_brute_force(docs, texts, empty):
    names = [k if k != 5 else None for k in range(len(texts))] + [len(texts) - 1]
    sets = _sets(texts + texts[-1:])
    links = [{j for j in range(len(sets)) if j != i and sets[i] and sets[j]
              and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9} for i in range(len(sets))]
    got = ngram_join.jaccard_links(docs, block_rows=2).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_links) for r in got) == \
        sorted((n if n is not None else -1, len(x)) for n, x in zip(names, links))
    kept = ngram_join.drop_near_copies(docs)
    assert kept.columns == docs.columns
    seen, groups = set(), 0
    for i in range(len(sets)):
        if i not in seen:
            groups += 1
            todo = [i]
            while todo:
                k = todo.pop()
                if k not in seen:
                    seen.add(k)
                    todo += links[k]
    assert kept.count() == groups
    assert ngram_join.jaccard_links(empty).count() == 0


def test_pruning_keeps_what_reaches_the_threshold():
    need = ngram_join.min_equal(0.8, 1e-9)
    assert all(need[a] < need[b] for a, b in zip(list(need), list(need)[1:]))
    rnd = np.random.default_rng(0)
    common = rnd.integers(0, 2**63, 900, dtype=np.uint64)
    a = np.unique(np.concatenate([common, rnd.integers(0, 2**63, 100, dtype=np.uint64)]))
    b = np.unique(np.concatenate([common, rnd.integers(0, 2**63, 100, dtype=np.uint64)]))
    c = np.unique(rnd.integers(0, 2**63, 1000, dtype=np.uint64))
    i, j = ngram_join.prune(ngram_join.minhash([a, b, c]), None, need)
    assert list(zip(i, j)) == [(0, 1)]


# ---- 4: neighbours

def test_neighbours_exact_when_all_leaves_are_taken(spark):
    df = _emb(spark)
    got = ann.nearest(df, df.where("vec_id % 50 = 0"), k=5, reach=1e9, block_rows=32, leaf_rows=8, trees=3).collect()
    rows = {r.vec_id: np.array(r.embedding) for r in df.collect() if r.embedding and None not in r.embedding
            and np.isfinite(r.embedding).all() and np.any(r.embedding) and len(r.embedding) == 16}
    for q in [k for k in rows if k % 50 == 0]:
        want = sorted((float(np.sqrt(((v - rows[q]) ** 2).sum())), k) for k, v in rows.items() if k != q)[:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == [w[1] for w in want] and [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert np.allclose([m[2] for m in mine], [w[0] for w in want], atol=1e-12)
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_neighbours_among_ties_and_large_norms(spark):
    ids = random.Random(8).sample(range(1000), 64)
    ties = spark.createDataFrame([(i, np.eye(64)[k].tolist()) for k, i in enumerate(ids)], "vec_id long, embedding array<double>")
    got = ann.nearest(ties, ties, k=5, reach=1e9, leaf_rows=48, trees=3).collect()
    for q in ids:
        assert sorted(r.vec_id for r in got if r.query_id == q) == sorted(set(ids) - {q})[:5]
    # far from the origin the rough distances are mostly rounding
    x = 1e8 + np.random.default_rng(3).standard_normal((400, 8))
    far = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(far, far.where("vec_id % 20 = 0"), k=5, reach=1e9, leaf_rows=200, trees=3).collect()
    for q in range(0, 400, 20):
        want = sorted((float(np.sqrt(((x[k] - x[q]) ** 2).sum())), k) for k in range(400) if k != q)[:5]
        assert [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == [k for _, k in want]


def test_forest_recall(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 32))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.nearest(df, df.where("vec_id % 100 = 0")).collect()
    hit = 0
    for q in range(0, 4000, 100):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(d)[:10].tolist()))
    assert hit / 400 >= 0.9


# ---- 5: sharding

def test_lookup_table_is_balanced_and_stable(spark, docs):
    names = [f"n{k}" for k in range(7)]
    table = sharding.fill(names, 1021)
    count = np.bincount(table)
    assert count.max() - count.min() <= 1
    fewer = sharding.fill(names[:-1], 1021)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.2 * 1021
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)
    out = sharding.place(docs, F.col("doc_id"), sharding.lookup_table(spark, names, 1021), 1021)
    assert out.count() == docs.count() and out.where("shard is null").count() == 0


# ---- 6: suffix array

def _cut(raws, length):
    seen = {}
    for r in raws:
        for i in range(len(r) - length + 1):
            seen[r[i:i + length]] = seen.get(r[i:i + length], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - length + 1):
            if seen[r[i:i + length]] > 1:
                gone[i:i + length] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((len(r), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup_equals_brute_force(docs, texts, empty, hot):
    want = _cut([(t or "").encode() for t in texts + texts[-1:]], 60)
    got = suffix_dedup.remove_repeats(docs, length=60, hot=hot).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(want)
    if hot == 2:
        assert suffix_dedup.remove_repeats(empty, length=60).count() == 0


def test_cut_texts_keeps_columns_and_empty_rows(docs, texts):
    out = suffix_dedup.cut_texts(docs, length=60)
    assert out.columns == docs.columns and out.where("text is null").count() == 1
    want = _cut([(t or "").encode() for t in texts + texts[-1:]], 60)
    assert out.count() == sum(n == 0 or gone < n for n, gone, _, _ in want)


def test_merge_is_a_sorted_array_with_its_prefix_table():
    rnd = random.Random(1)
    runs = []
    for _ in range(5):
        some = sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(0, 30)))
        runs.append((some, suffix_dedup.front_code(some)[0].tolist()))
    order, shared = suffix_dedup.merge(runs)
    merged = [runs[r][0][k] for r, k in order]
    assert merged == sorted(x for some, _ in runs for x in some)
    assert shared[1:] == [suffix_dedup.common(a, b, 0) for a, b in zip(merged, merged[1:])]


# ---- 7, 9, 10: classifiers

def test_chain_marginals_equal_enumeration():
    gap, move, start = np.array([[0.3, -1.2, 2.0]]), np.array([[0.5, -0.4], [0.2, 0.7]]), -0.6
    _, _, p = toxicity.passes(gap, np.array([3]), move, start)
    total, on = 0.0, np.zeros(3)
    for s in range(8):
        y = [(s >> k) & 1 for k in range(3)]
        w = np.exp(start * y[0] + sum(gap[0][k] * y[k] for k in range(3)) + move[y[0], y[1]] + move[y[1], y[2]])
        total += w
        on += w * np.array(y)
    assert np.allclose(p[0], on / total)


def test_toxicity_held_out(spark, empty):
    rnd = random.Random(2)
    rows, labels = [], []
    for k in range(600):
        w = _words(rnd, rnd.randint(5, 60)).split()
        bad = k % 4 == 0
        if bad:
            for _ in range(4):
                w.insert(rnd.randint(0, len(w)), rnd.choice(["vilex", "grubbo", "snarl"]) + rnd.choice(["", ",", "s"]))
        rows.append((k, " ".join(w)))
        labels.append((k, int(bad)))
    rows += [(9000, None), (9001, ""), (None, "vilex")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x"))
    y = spark.createDataFrame(labels + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(d, y.where("doc_id % 3 != 0"))
    got = {r.doc_id: r for r in toxicity.score(d, model).collect()}
    held = [k for k in range(0, 600, 3)]
    assert np.mean([got[k].predicted == int(k % 4 == 0) for k in held]) > 0.95
    assert got[9000].predicted == 0 and got[9000].score == got[9001].score
    text = dict(rows)[4]
    assert all(text[s.start:s.end].strip(",") .startswith(("vilex", "grubbo", "snarl")) for s in got[4].spans)
    assert toxicity.score(empty, model).count() == 0
    assert toxicity.fit(d, y.limit(0)) == 0.0


def test_language_evidence(spark):
    rnd = random.Random(5)
    word = {"aa": ["bala", "lamo", "balamo"], "bb": ["trisk", "skrit", "triskrit"]}
    known = spark.createDataFrame([(" ".join(rnd.choice(word[x]) for _ in range(30)), x) for x in word for _ in range(50)],
                                  "text string, lang string")
    model = language.fit_text(known, "text", "lang")
    rows = [(" ".join(rnd.choice(word[x]) for _ in range(8)), x, "h1", "s") for x in word for _ in range(20)]
    rows += [(None, "aa", "h1", "s"), ("", None, None, None), ("12 !!", "aa", "h1", None), ("x" * 100_000, None, "new", None)]
    df = spark.createDataFrame(rows, "text string, want string, host string, suffix string").withColumn("_ll", F.lit(1))
    got = language.identify(df, model, "text", F.col("want"), F.col("suffix"), F.col("host")).collect()
    real = [r for r in got if r.text and " " in r.text and r.want in word and r.host and r.suffix]
    assert len(real) == 40 and all(r.language == r.want and r.accepted for r in real)
    assert not any(r.accepted for r in got if not r.text or not any(c.isalpha() for c in r.text))
    assert len(got) == len(rows)
    none = language.fit_text(known.limit(0), "text", "lang")
    assert language.identify(df, none, "text").where("accepted").count() == 0


def test_language_sample_of_copies_and_spans(spark):
    long = "z" * 50_000
    one = [(f"only this text {k}", "aa") for k in range(40)]
    once, often = (language.fit_text(spark.createDataFrame(rows + [(long + "ok", "bb")], "text string, lang string"), "text", "lang")
                   for rows in (one, one + one[:1] * 3000))
    assert once.langs == often.langs and np.array_equal(once.logp, often.logp)
    # the place of a span depends on the text: what stands at the end of long texts is seen too
    tails = spark.createDataFrame([("x" * 4000 + f"{k:04d}" + "q" * 3000, "aa") for k in range(60)], "text string, lang string")
    model = language.fit_text(tails, "text", "lang")
    assert model.loglik(["qqqq"])[0, 0] > -10
    many = spark.createDataFrame([("text", f"l{k}") for k in range(language.MOST_LANGUAGES + 1)], "text string, lang string")
    with pytest.raises(ValueError):
        language.fit_text(many, "text", "lang")


def test_page_evidence(spark):
    df = spark.createDataFrame([('<HTML lang="FR"><script>x</script><p>Un mot</p>', "https://a.example.org/fr/1?x"),
                                (None, None)], "html string, url string")
    a, b = language.page_evidence(df).collect()
    assert (a.page_declared, a.page_host, a.page_suffix, a.page_text.strip()) == ("fr", "a.example.org", "org", "Un mot")
    assert (b.page_declared, b.page_host, b.page_suffix, b.page_text) == (None, None, None, "")


def test_quality_shrinks_sparse_sites(spark, empty):
    rnd = random.Random(6)
    rows, labels = [], []
    for k in range(400):
        bad = k % 5 == 0
        t = _words(rnd, 40)
        rows.append((k, "".join(w + "### " for w in t.split()) if bad else t, f"h{k % 4}", "p"))
        labels.append((k, int(not bad)))
    rows += [(900, None, None, None), (901, "", "lone", None), (None, "plain words here", "h1", "p")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("keep", F.lit("c"))
    y = spark.createDataFrame(labels + [(None, 0), (3, None)], "doc_id long, quality int")
    out = quality.keep_good(d, d, y)
    assert out.columns == d.columns
    kept = {r.doc_id for r in out.collect()}
    assert np.mean([(k in kept) == (k % 5 != 0) for k in range(400)]) > 0.97
    model = quality.fit(d, y)
    got = quality.score(d.drop("keep"), model, F.col("source"), F.col("lang")).collect()
    assert len(got) == len(rows) and all(0 <= r.quality_p <= 1 for r in got)
    rates = [r.host_rate for r in got if r.source == "lone"]
    assert 0.3 < rates[0] < 1.0
    assert quality.fit(d, y.limit(0)) == 1.0
