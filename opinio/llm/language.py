"""Language identification by Bayesian evidence fusion.

posterior(language) ~ text likelihood x P(declared | language) x P(suffix | language) x host prior

* Text: hashed byte 3-grams under a multinomial model per language, fitted on a
  bounded sample of distinct texts with known language (``sample_rows`` a language, at most
  MOST_LANGUAGES languages; more raise a ValueError). The
  log-likelihood is tempered (``temper``): neighbouring n-grams repeat
  each other's evidence.
* Declared markup language and address suffix: P(value | language) from all rows,
  each weighing its text posterior, smoothed by ``smooth`` rows spread by the value's overall share.
* Host prior: mean text posterior of the host's rows, shrunk toward that of its
  address suffix by ``strength`` rows, which is shrunk toward the global mean likewise.

All counts are grouped aggregations over all rows with a few sums per group, so a
host with a third of the rows costs one partial row per task.

A row is rejected (``accepted`` false) when its text holds no letter or no language reaches
``least`` posterior.

Edge cases. NULL or empty text: no text evidence, rejected. Missing
declared value, suffix or host: that evidence is left out. Repeated rows count
each. Texts of any length are read whole. Of equally probable languages the first by name is given.
With no labelled row at all every row is rejected with a NULL language.
An empty table gives an empty result; extra columns are kept, whatever their names, but for the three of the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinio.llm.common import bundled, land, ship, table, trim

ship(__name__)

BUCKETS = 1 << 16
SAMPLE_ROWS = 1500
MOST_LANGUAGES = 200
TEMPER = 0.3
SMOOTH = 20.0
STRENGTH = 50.0
LEAST = 0.6


def grams(raw: np.ndarray) -> np.ndarray:
    """Hash slot of the byte 3-gram that starts at each place."""
    x = raw.astype(np.uint32)
    return ((x[:-2] * 40503 + x[1:-1] * 2654435 + x[2:] * 97) * np.uint32(2654435761) >> 16).astype(np.int64)


class TextModel:
    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp  # (BUCKETS, languages)

    def loglik(self, texts) -> np.ndarray:
        """(texts, languages) log-likelihoods of whole texts (lower-cased)."""
        out = np.zeros((len(texts), len(self.langs)))
        for k, t in enumerate(texts):
            raw = (t or "").lower().encode("utf-8", "surrogatepass")
            for lo in range(0, len(raw) - 2, 1 << 20):
                part = np.frombuffer(raw[lo:lo + (1 << 20) + 2], np.uint8)
                out[k] += self.logp[grams(part)].sum(0, dtype=np.float64)
        return out


def fit_text(rows: DataFrame, text_col: str, lang_col: str, sample_rows: int = SAMPLE_ROWS) -> TextModel:
    """Per-language 3-gram model from about ``sample_rows`` distinct whole texts of each
    language, drawn by their hash and counted on the executors. More than MOST_LANGUAGES languages raise a
    ValueError: none is left out."""
    known = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    count = {r[0]: r[1] for r in known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text"), 0.02))
             .limit(MOST_LANGUAGES + 1).collect()}
    if len(count) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in {lang_col}")
    if not count:
        return TextModel([], np.zeros((BUCKETS, 0), np.float32))
    rate = F.create_map(*[x for lang, n in count.items() for x in (F.lit(lang), F.lit(min(1.0, sample_rows / max(1, n))))])
    # by text and language, so that copies of a text count once in each language
    draw = F.pmod(F.xxhash64("text", "lang", F.lit(13)), F.lit(1 << 20)) < F.element_at(rate, F.col("lang")) * F.lit(1 << 20)
    drawn = known.where(draw).select("lang", F.xxhash64("text").alias("key"), F.md5("text").alias("digest"), "text")
    drawn = drawn.dropDuplicates(["lang", "key", "digest"]).select("lang", "text")
    langs = sorted(count)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
                mine = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for lo in range(0, len(raw) - 2, 1 << 20):
                    mine += np.bincount(grams(raw[lo:lo + (1 << 20) + 2]), minlength=BUCKETS)
        for lang, mine in held.items():
            slot = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(slot), pa.string()), pa.array(slot, pa.int32()),
                                              pa.array(mine[slot])], ["lang", "slot", "n"])

    summed = (drawn.mapInArrow(counts, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
              .toArrow())
    held = np.full((BUCKETS, len(langs)), 0.05)
    place = {lang: k for k, lang in enumerate(langs)}
    which = np.array([place[x] for x in summed["lang"].to_pylist()], np.int64)
    held[summed["slot"].to_numpy(), which] += summed["n"].to_numpy()
    return TextModel(langs, np.log(held / held.sum(0)).astype(np.float32))


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


RESULTS = ("language", "language_p", "accepted")


def identify(rows: DataFrame, model: TextModel, text: str | Column, declared: Column | None = None,
             suffix: Column | None = None, host: Column | None = None, drop: tuple[str, ...] = (), **parameters) -> DataFrame:
    """``rows`` without the columns ``drop`` (read, but not kept), with ``language``, ``language_p`` (posterior) and
    ``accepted``, which replace columns of these names."""
    out = _identified(rows, model, text, declared, suffix, host, drop, **parameters)
    kept = [F.col("row").getField(c).alias(c) for c in rows.columns if c not in (*RESULTS, *drop)]
    return out.select(*kept, *RESULTS)


def _identified(rows: DataFrame, model: TextModel, text: str | Column, declared: Column | None = None,
                suffix: Column | None = None, host: Column | None = None, drop: tuple[str, ...] = (),
                temper: float = TEMPER, smooth: float = SMOOTH,
                strength: float = STRENGTH, least: float = LEAST) -> DataFrame:
    """``row`` (all of a row as one struct, so that no column's name can clash with those used here) and the results."""
    text = F.col(text) if isinstance(text, str) else text
    langs = model.langs
    if not langs:
        return rows.select(bundled(rows, *drop).alias("row"), F.lit(None).cast("string").alias("language"),
                           F.lit(0.0).alias("language_p"), F.lit(False).alias("accepted"))
    none = F.lit(None).cast("string")
    ev = {"_declared": declared, "_suffix": suffix, "_host": host}
    rows = rows.select(bundled(rows, *drop).alias("row"), text.alias("_text"),
                       *[(none if c is None else F.lower(c.cast("string"))).alias(k) for k, c in ev.items()])

    @F.pandas_udf("array<double>")
    def loglik(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = temper * model.loglik(texts)
            yield pd.Series([None if not any(c.isalpha() for c in (t or "")) else r for t, r in zip(texts, out)])
        trim()

    n = len(langs)
    # the model reads every text once: rows and their evidence are written, for both the grouped counts and the decision
    scored = land(rows.withColumn("_ll", loglik("_text")).drop("_text"), "language-scored")
    post = F.transform("_ll", lambda x: F.exp(x - F.array_max("_ll")))
    total = F.aggregate(F.col("_post"), F.lit(0.0), lambda a, x: a + x)
    slim = (scored.select("_declared", "_suffix", "_host", "_ll").where("_ll is not null")
            .withColumn("_post", post).withColumn("_post", F.transform("_post", lambda x: x / total)).drop("_ll"))
    sums = [F.sum(F.get("_post", F.lit(k))).alias(f"s{k}") for k in range(n)]
    whole = slim.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    mass = [float(whole[f"s{k}"] or 0) + 1.0 / n for k in range(n)]
    base = [m / sum(mass) for m in mass]
    rows_n = float(whole["n"] or 0)

    def likelihood(col: str) -> DataFrame:
        """value -> log P(value | language)."""
        g = slim.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"), *sums)
        return g.select(col, F.array(*[
            F.log((F.col(f"s{k}") + smooth * F.col("n") / F.lit(max(1.0, rows_n))) / F.lit(mass[k] + smooth))
            for k in range(n)]).alias(f"{col}_l"))

    by_suffix = (slim.where("_host is not null").groupBy("_suffix").agg(F.count(F.lit(1)).alias("n"), *sums)
                 .select("_suffix", *[((F.col(f"s{k}") + strength * base[k]) / (F.col("n") + strength)).alias(f"b{k}")
                                      for k in range(n)]))
    by_host = (slim.where("_host is not null").groupBy("_host", "_suffix").agg(F.count(F.lit(1)).alias("n"), *sums)
               .alias("h").join(by_suffix.alias("b"), F.expr("h._suffix <=> b._suffix"))
               .select("h._host", F.col("h._suffix").alias("_hs"), F.array(*[
                   F.log((F.col(f"s{k}") + strength * F.col(f"b{k}")) / (F.col("n") + strength))
                   for k in range(n)]).alias("_prior")))
    out = scored
    if host is not None:
        out = out.alias("r").join(land(by_host, "language-hosts").withColumnRenamed("_host", "_hh"),
                                  (F.col("_host") == F.col("_hh")) & F.col("_suffix").eqNullSafe(F.col("_hs")),
                                  "left").drop("_hh", "_hs")
    else:
        out = out.withColumn("_prior", F.lit(None).cast("array<double>"))
    for col, given in (("_declared", declared), ("_suffix", suffix)):
        if given is not None:
            out = out.join(land(likelihood(col), "language-" + col[1:]), col, "left")
        else:
            out = out.withColumn(f"{col}_l", F.lit(None).cast("array<double>"))
    zero = F.array(*[F.lit(0.0)] * n)
    start = F.array(*[F.lit(float(np.log(b))) for b in base])
    parts = [F.coalesce("_ll", zero), F.coalesce("_prior", start), F.coalesce("_declared_l", zero),
             F.coalesce("_suffix_l", zero)]
    out = out.withColumn("_sum", F.array(*[sum((F.get(p, F.lit(k)) for p in parts[1:]), F.get(parts[0], F.lit(k)))
                                           for k in range(n)]))
    top = F.array_max("_sum")
    out = out.withColumn("language_p", F.lit(1.0) / F.aggregate("_sum", F.lit(0.0), lambda a, x: a + F.exp(x - top)))
    out = out.withColumn("language", F.element_at(F.array(*[F.lit(x) for x in langs]),
                                                  F.array_position("_sum", top).cast("int")))
    out = out.withColumn("accepted", F.col("_ll").isNotNull() & (F.col("language_p") >= least))
    return out.select("row", *RESULTS)


def plain_text(html: str) -> Column:
    """The text of raw markup (NULL: empty)."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ")


def page_evidence(pages: DataFrame) -> DataFrame:
    """Text, declared markup language, host and address suffix (last label of
    the host) of raw pages, all by SQL functions."""
    html = F.coalesce("html", F.lit(""))
    body = plain_text("html")
    declared = F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1)
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1)
    blank = lambda c: F.when(c != "", F.lower(c))
    return (pages.withColumn("page_text", body).withColumn("page_declared", blank(declared))
            .withColumn("page_host", blank(host))
            .withColumn("page_suffix", blank(F.regexp_extract("page_host", r"([^.]+)$", 1))))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """Raw pages; the text model is fitted on a sample of ``documents``."""
    model = fit_text(table(spark, sf_dir, "documents"), "text", "lang")
    pages = page_evidence(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return identify(pages.select("page_id", "html", "page_declared", "page_suffix", "page_host"), model, plain_text("html"),
                    F.col("page_declared"), F.col("page_suffix"), F.col("page_host"), drop=("html",)).select(
        "page_id", "language", F.round("language_p", 6).alias("language_p"), "accepted",
        F.col("page_declared").alias("declared"), F.col("page_host").alias("host"))


def keep_identified(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Documents whose language is identified, from their text and the prior of their source."""
    model = fit_text(known, "text", "lang")
    out = _identified(docs, model, "text", host=F.col("source")).where("accepted")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
