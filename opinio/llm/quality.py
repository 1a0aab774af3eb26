"""Quality by hierarchical empirical Bayes.

* Document evidence: a ridge logistic regression on shape features of the text
  (shares of letters, capitals, signs, repeated words, ...), fitted on a bounded
  sample of labelled rows (``sample_rows``).
* Site evidence: for every host and every path of a host, the expected number of good
  documents (classifier probabilities of all its rows). Host rates are shrunk toward the
  global rate, path rates toward their host's, each by a prior weight estimated from
  the spread of the rates (method of moments), so sparse sites follow their parent.
* Posterior: logit = logit(document) + logit(path rate) - logit(global rate).

Sites are grouped aggregations of sums, so a host with a third of all rows is one
partial row per task.

Edge cases. NULL or empty text: feature values of an empty text. NULL host
or path: a site of its own. Repeated rows count each; NULL labels or ids never
train. Without labelled rows of both kinds every score is the share of good labels (1
without any). Very long texts are read whole. A posterior of exactly ``least`` is kept.
An empty table gives an empty result; extra columns are kept, whatever their names, but for the five of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import bundled, land, ship, table, trim
from opinio.llm.toxicity import logistic

ship(__name__)

SAMPLE_ROWS = 20_000
LEAST = 0.5
NAMES = ("upper", "digit", "sign", "bar", "space", "line", "other", "words", "distinct", "longest_run", "word_len", "long")

_KIND = np.full(256, 6, np.uint8)  # bytes outside the classes below
_KIND[ord("a"):ord("z") + 1] = 7
_KIND[128:] = 7
_KIND[ord("A"):ord("Z") + 1] = 0
_KIND[ord("0"):ord("9") + 1] = 1
for _c in b"!#$%&*+<=>@^_~\\/{}[]":
    _KIND[_c] = 2
_KIND[ord("|")] = 3
_KIND[ord(" ")] = 4
_KIND[ord("\n")] = 5


def shape(text: str | None) -> list[float]:
    """Shape features of a whole text, each between 0 and about 1."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return [0.0] * len(NAMES)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8)[:7] / len(raw)
    words = (text or "").split()
    n = len(words)
    if n > 1:
        same = np.fromiter((a == b for a, b in zip(words, words[1:])), bool, n - 1).mean()
    else:
        same = 0.0
    return [*kinds.tolist(), min(1.0, n / 50), len(set(words[:])) / max(1, n) if n < 200 else min(1.0, len(set(words)) / n**0.8),
            float(same), min(2.0, len(raw) / max(1, n) / 10), float(np.log1p(n)) / 10]


def _probabilities(texts, model: np.ndarray | float) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    x = np.array([shape(t) for t in texts]).reshape(-1, len(NAMES))
    return 1 / (1 + np.exp(-np.clip(np.column_stack([x, x * x, np.ones(len(x))]) @ model, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample_rows: int = SAMPLE_ROWS) -> np.ndarray | float:
    """Classifier weights, from about ``sample_rows`` labelled rows (only their features reach the driver)."""
    y = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
         .agg(F.max(label_col).cast("int").alias("y")))
    total = y.count()
    keep = int(min(1.0, sample_rows / max(1, total)) * (1 << 20))
    y = y.where(F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 20)) < keep)

    @F.pandas_udf("array<double>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shape(t) for t in texts])

    # the drawn ids are bounded by ``sample_rows``: they go to the texts, not the texts to them
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(y), "id")
            .select("y", features("text").alias("x")).limit(2 * sample_rows).collect())
    good = np.array([r.y for r in rows], float)
    if len(good) == 0 or good.min() == good.max():
        return float(good.mean()) if len(good) else 1.0
    x = np.array([r.x for r in rows])
    return logistic(np.column_stack([x, x * x]), good, np.ones(len(good)), ridge=0.1)


def _shrink(groups: DataFrame, good: str, n: str, prior: Column, weight: float) -> Column:
    return (F.col(good) + F.lit(weight) * prior) / (F.col(n) + F.lit(weight))


def prior_weight(groups: DataFrame, rate: Column, n: Column, prior: Column) -> float:
    """Method-of-moments weight (in rows) of a beta prior around ``prior``:
    between-group spread against the spread that sampling alone would give."""
    r = groups.agg(F.sum(n * (rate - prior) ** 2).alias("spread"), F.sum(prior * (1 - prior)).alias("alone"),
                   F.sum(n).alias("n"), F.sum(n * n).alias("n2"), F.sum(n * prior * (1 - prior)).alias("within")).first()
    if not r["n"]:
        return 1.0
    excess = float(r["spread"]) - float(r["alone"])
    if excess <= 0:
        return 1e4  # no spread beyond sampling: follow the parent
    between = excess / float(r["n"])
    return float(np.clip(float(r["within"]) / float(r["n"]) / between, 1.0, 1e4))


RESULTS = ("doc_p", "host_rate", "path_rate", "quality_p", "keep")


def score(docs: DataFrame, model: np.ndarray | float, host: Column, path: Column, text_col: str = "text",
          least: float = LEAST, drop: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` without the columns ``drop`` (read, but not kept), with ``doc_p`` (classifier), ``host_rate``, ``path_rate``,
    ``quality_p`` (posterior of being good) and ``keep``, which replace columns of these names."""
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (*RESULTS, *drop)]
    return _scored(docs, model, host, path, text_col, least, drop).select(*kept, *RESULTS)


def _scored(docs: DataFrame, model: np.ndarray | float, host: Column, path: Column, text_col: str = "text",
            least: float = LEAST, drop: tuple[str, ...] = ()) -> DataFrame:
    """``row`` (all of a row as one struct, so that no column's name can clash with those used here) and the results."""

    @F.pandas_udf("double")
    def chance(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_probabilities(texts, model))
        trim()

    # the model reads every text once: rows and their evidence are written, for both the site rates and the decision
    rows = land(docs.select(bundled(docs, *drop).alias("row"), host.cast("string").alias("_host"), path.cast("string").alias("_path"),
                            chance(text_col).alias("doc_p")), "quality-scored")
    paths = land(rows.groupBy("_host", "_path").agg(F.sum("doc_p").alias("good"), F.count(F.lit(1)).alias("n")), "quality-paths")
    hosts = paths.groupBy("_host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    whole = hosts.agg(F.sum("good").alias("good"), F.sum("n").alias("n")).first()
    base = (float(whole["good"] or 0) + 1) / (float(whole["n"] or 0) + 2)
    w_host = prior_weight(hosts, F.col("good") / F.col("n"), F.col("n").cast("double"), F.lit(base))
    hosts = hosts.select(F.col("_host").alias("_h"), _shrink(hosts, "good", "n", F.lit(base), w_host).alias("host_rate"))
    both = paths.join(hosts, F.col("_host").eqNullSafe(F.col("_h"))).drop("_h")
    w_path = prior_weight(both, F.col("good") / F.col("n"), F.col("n").cast("double"), F.col("host_rate"))
    rates = land(both.select(F.col("_host").alias("_h"), F.col("_path").alias("_p"), "host_rate",
                             _shrink(both, "good", "n", F.col("host_rate"), w_path).alias("path_rate")), "quality-rates")
    out = rows.join(rates, F.col("_host").eqNullSafe(F.col("_h")) & F.col("_path").eqNullSafe(F.col("_p")), "left")
    safe = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda c: F.log(safe(c) / (1 - safe(c)))
    z = logit(F.col("doc_p")) + logit(F.coalesce("path_rate", F.lit(base))) - logit(F.lit(base))
    out = out.withColumn("quality_p", 1 / (1 + F.exp(-z))).withColumn("keep", F.col("quality_p") >= least)
    return out.select("row", *RESULTS)


def held_out(col: str) -> Column:
    """The third of the ids that never trains."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 3 == 1, F.lit(False))


def op10_eb_quality(spark, sf_dir: str) -> DataFrame:
    """Host: ``source``; path: the language section of the source."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.where(~held_out("doc_id")))
    docs = docs.select("doc_id", "text", "source", "lang")
    return score(docs, model, F.col("source"), F.col("lang"), drop=("text",)).select(
        "doc_id", held_out("doc_id").alias("held_out"), F.round("doc_p", 6).alias("doc_p"),
        F.round("host_rate", 6).alias("host_rate"), F.round("path_rate", 6).alias("path_rate"),
        F.round("quality_p", 6).alias("quality_p"), "keep")


def keep_good(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(labelled, labels)
    out = _scored(docs, model, F.col("source"), F.col("lang")).where("keep")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
