"""Toxicity by a linear-chain conditional random field over words.

* Labelled tokens. Labels are given by document, so training tokens get theirs from
  what toxic and clean training documents hold: a feature (a word or the start of one)
  that occurs in several toxic documents and hardly any clean one marks the
  tokens that carry it, in toxic documents only.
* Training. Two-state chain (clean, toxic) with features of the word and two-by-two
  transitions; the log-likelihood of the labelled tokens is maximised with exact
  forward-backward gradients on a bounded sample (``sample_docs`` documents of
  each label) on the driver.
* Scoring. Every word of every text gets its toxic marginal by forward-backward;
  the largest marginal and the logarithm of their sum go through a logistic
  model (fitted on the same sample, weighted to the labels' true rates) to the document
  score. Words with a marginal of at least one half are the offending spans.

Labels, language, source and id are inputs of the training rows only.

Edge cases. NULL or empty text: score of a document without toxic words, no spans.
Very long texts are scored whole. Repeated rows score alike. Rows without
label are scored; a NULL label or id never trains. With no labelled row of one of the
two labels every score is the share of toxic labels (0 without any). An empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import ship, table

ship(__name__)

SAMPLE_DOCS = 2500
CHUNK = 256
STEPS = 60
BUCKETS = 1 << 18
PREDICT = 0.7
_EDGE = re.compile(r"^\W+|\W+$")


def features(word: str) -> list[str]:
    """The word without signs around it, and its starts."""
    w = _EDGE.sub("", word.lower()) or word
    return ["w:" + w] + [f"p{n}:{w[:n]}" for n in (4, 5, 6) if len(w) > n] + ["s:" + w[-3:], "b"]


def _slots(word: str) -> np.ndarray:
    got = [xxhash.xxh32_intdigest(f) & (BUCKETS - 1) for f in features(word)]
    return np.array((got + [BUCKETS] * 6)[:6], np.int64)  # slot BUCKETS always weighs nothing


def passes(gap: np.ndarray, length: np.ndarray, move: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward odds of state 1 and its marginals, for sequences
    in the rows of ``gap`` (score of state 1 less that of state 0; ``length`` words each)."""
    rows, width = gap.shape
    e = np.exp(np.clip(gap, -30, 30))
    m = np.exp(move)
    ahead = np.empty_like(e)
    odds = e[:, 0] * np.exp(start)
    ahead[:, 0] = odds
    for t in range(1, width):
        odds = np.clip(e[:, t] * (odds * m[1, 1] + m[0, 1]) / (odds * m[1, 0] + m[0, 0]), 1e-30, 1e30)
        ahead[:, t] = odds
    back = np.ones_like(e)
    b = np.ones(rows)
    for t in range(width - 2, -1, -1):
        x = e[:, t + 1] * b
        b = np.where(t + 1 < length, (m[1, 1] * x + m[1, 0]) / (m[0, 1] * x + m[0, 0]), 1.0)
        back[:, t] = b
    both = ahead * back
    return ahead, back, both / (1 + both)


class Model:
    """Weights of the chain and of the document score."""

    def __init__(self, weight, move, start, score):
        self.weight, self.move, self.start, self.score = weight, move, start, score

    def doc_features(self, marginals: np.ndarray) -> tuple[float, float]:
        if len(marginals) == 0:
            return 0.0, 0.0
        return float(marginals.max()), float(np.log1p(marginals.sum()))


def token_marks(texts: list[list[str]], toxic: np.ndarray) -> dict[str, bool]:
    """word -> does it mark a toxic token, by document counts of its features."""
    bad, good = Counter(), Counter()
    of: dict[str, list[str]] = {}
    for words, y in zip(texts, toxic):
        seen = set()
        for w in set(words):
            if w not in of:
                of[w] = [f for f in features(w) if f[0] in "wp"]
            seen.update(of[w])
        (bad if y else good).update(seen)
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    strong = {f for f, n in bad.items() if n >= max(4, n_bad // 400)
              and (n + 0.5) / n_bad >= 15 * (good[f] + 0.5) / n_good}
    return {w: any(f in strong for f in fs) for w, fs in of.items()}


def train(texts: list[str], toxic: np.ndarray, weight_of: np.ndarray, steps: int = STEPS) -> Model:
    """Fit the chain on labelled tokens, then the document score."""
    toxic = np.asarray(toxic, bool)
    split = [(t or "").split() for t in texts]
    marks = token_marks(split, toxic)
    vocabulary = {w: k for k, w in enumerate(marks)}
    slots = np.array([_slots(w) for w in vocabulary]).reshape(-1, 6)
    chunks, labels, owner = [], [], []
    for d, words in enumerate(split):
        at = [vocabulary[w] for w in words]
        y = [toxic[d] and marks[w] for w in words]
        for lo in range(0, len(at), CHUNK):
            chunks.append(at[lo:lo + CHUNK])
            labels.append(y[lo:lo + CHUNK])
            owner.append(d)
    length = np.array([len(c) for c in chunks])
    order = np.argsort(length, kind="stable")
    groups = [order[k:k + 1024] for k in range(0, len(order), 1024)]
    packed = []
    for g in groups:
        w = length[g].max()
        word = np.zeros((len(g), w), np.int64)
        y = np.zeros((len(g), w))
        for r, c in enumerate(g):
            word[r, :length[c]] = chunks[c]
            y[r, :length[c]] = labels[c]
        packed.append((word, y, length[g], np.arange(w)[None, :] < length[g][:, None], g))
    theta = np.zeros(BUCKETS + 1)
    theta[xxhash.xxh32_intdigest("b") & (BUCKETS - 1)] = -2.0
    move, start = np.array([[0.5, -0.5], [0.0, 0.0]]), -1.0
    m1, m2 = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    used = np.unique(slots)
    n_tokens = max(1, int(length.sum()))
    for step in range(1, steps + 1):
        emit = theta[slots].sum(1)
        g_word = np.zeros(len(vocabulary))
        g_move, g_start = np.zeros((2, 2)), 0.0
        for word, y, ln, inside, _ in packed:
            gap = emit[word]
            ahead, back, p = passes(gap, ln, move, start)
            err = np.where(inside, p - y, 0.0)
            g_word += np.bincount(word.ravel(), weights=err.ravel(), minlength=len(vocabulary))
            g_start += err[:, 0].sum()
            if word.shape[1] > 1:
                x = np.exp(np.clip(gap[:, 1:], -30, 30)) * back[:, 1:]
                a, m = ahead[:, :-1], np.exp(move)
                joint = np.stack([m[0, 0] * np.ones_like(a), m[0, 1] * x, a * m[1, 0], a * m[1, 1] * x])
                joint = joint / joint.sum(0)
                seen = inside[:, 1:]
                y0, y1 = y[:, :-1], y[:, 1:]
                true = np.stack([(1 - y0) * (1 - y1), (1 - y0) * y1, y0 * (1 - y1), y0 * y1])
                g_move += ((joint - true) * seen).sum((1, 2)).reshape(2, 2)
        g = np.bincount(slots.ravel(), weights=np.repeat(g_word, 6), minlength=BUCKETS + 1)
        g[BUCKETS] = 0
        g = g / n_tokens * 1000 + 1e-3 * theta
        m1[used] = 0.9 * m1[used] + 0.1 * g[used]
        m2[used] = 0.99 * m2[used] + 0.01 * g[used] ** 2
        theta[used] -= 0.3 * (m1[used] / (1 - 0.9**step)) / (np.sqrt(m2[used] / (1 - 0.99**step)) + 1e-6)
        move -= np.clip(g_move / n_tokens * 5, -0.2, 0.2)
        start -= float(np.clip(g_start / max(1, len(chunks)), -0.2, 0.2))
    model = Model(theta.astype(np.float32), move, start, None)
    scored = marginals(model, texts)
    x = np.array([model.doc_features(p) for p in scored])
    model.score = logistic(x, toxic.astype(float), weight_of)
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights (bias last) of a ridge logistic regression, by Newton steps."""
    z = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (weight * (p - y)) + ridge * w
        h = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w = w - d
        if np.abs(d).max() < 1e-8:
            break
    return w


class _Emission(dict):
    """word -> emission score, remembered up to a bound."""

    def __init__(self, weight: np.ndarray):
        super().__init__()
        self.weight = weight

    def __missing__(self, word: str) -> float:
        if len(self) > 300_000:
            self.clear()
        self[word] = s = float(self.weight[_slots(word)].sum())
        return s


def marginals(model: Model, texts, seen: _Emission | None = None) -> list[np.ndarray]:
    """Toxic marginal of every word of every text."""
    seen = _Emission(model.weight) if seen is None else seen
    scores = []
    for t in texts:
        words = (t or "").split()
        scores.append(np.fromiter(map(seen.__getitem__, words), np.float64, len(words)))
    out: list[np.ndarray] = [np.empty(0)] * len(scores)
    order = sorted((k for k in range(len(scores)) if len(scores[k])), key=lambda k: len(scores[k]))
    while order:
        width = len(scores[order[-1]])
        take = order[-max(1, 1_000_000 // width):]
        if width > 64:  # no shorter than half the longest
            take = [k for k in take if 2 * len(scores[k]) >= width]
        del order[-len(take):]
        gap = np.zeros((len(take), width))
        for r, k in enumerate(take):
            gap[r, :len(scores[k])] = scores[k]
        length = np.array([len(scores[k]) for k in take])
        _, _, p = passes(gap, length, model.move, model.start)
        for r, k in enumerate(take):
            out[k] = p[r, :length[r]]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample_docs: int = SAMPLE_DOCS) -> Model | float:
    """The model, from at most ``sample_docs`` documents of each label; a plain
    share where one label has none."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # ids and labels alone are joined; texts are read for the drawn ids only
    known = (texts.select("id").distinct()
             .join(labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
                   .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y")), "id"))
    count = {r.y: r.n for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count.get(0) or not count.get(1):
        return float(bool(count.get(1)))
    share = F.when(F.col("y") == 1, sample_docs / count[1]).otherwise(sample_docs / count[0])
    drawn = known.where(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 20)) < share * F.lit(1 << 20))
    # hashing draws sample_docs of each label on average
    ids = drawn.orderBy("id").collect()
    ids = [(r.id, r.y) for y in (0, 1) for r in [x for x in ids if x.y == y][:sample_docs]]
    if not ids:
        return float(count[1] / (count[0] + count[1]))
    # at most 2 * sample_docs rows; an id with several rows trains once
    chosen = F.broadcast(docs.sparkSession.createDataFrame(ids, drawn.select("id", "y").schema))
    rows = texts.join(chosen, "id").groupBy("id", "y").agg(F.min("text").alias("text")).orderBy("id").collect()
    y = np.array([r.y == 1 for r in rows])
    if y.all() or not y.any():
        return float(count[1] / (count[0] + count[1]))
    weight = np.where(y, count[1] / max(1, y.sum()), count[0] / max(1, (~y).sum()))
    return train([r.text for r in rows], y, weight / weight.mean())


def score(docs: DataFrame, model: Model | float, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = PREDICT) -> DataFrame:
    """id, score, predicted, spans (character offsets and marginal of toxic words)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = _Emission(model.weight) if isinstance(model, Model) else None
        for batch in batches:
            scores, spans = [], []
            if seen is None:
                scores, spans = [model] * len(batch), [[]] * len(batch)
            else:
                for t, p in zip(batch["text"], marginals(model, batch["text"], seen)):
                    z = float(np.dot(model.score[:-1], model.doc_features(p)) + model.score[-1])
                    scores.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
                    hot = set(np.flatnonzero(p >= 0.5).tolist())
                    spans.append([{"start": m.start(), "end": m.end(), "marginal": float(p[k])}
                                  for k, m in enumerate(re.finditer(r"\S+", t or "")) if k in hot] if hot else [])
            yield pd.DataFrame({"id": batch["id"].astype("Int64"), "score": scores,
                                "predicted": (np.array(scores) >= threshold).astype(np.int32), "spans": spans})

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return src.mapInPandas(run, "id bigint, score double, predicted int, "
                                "spans array<struct<start:int,end:int,marginal:double>>").withColumnRenamed("id", id_col)


def op7_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = lambda c: F.coalesce(F.crc32(F.col(c).cast("string")) % 3 == 1, F.lit(False))
    model = fit(docs, labels.where(~held("doc_id")))
    return score(docs, model).select("doc_id", held("doc_id").alias("held_out"), "score", "predicted", "spans")
