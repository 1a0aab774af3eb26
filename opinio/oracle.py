"""DuckDB SQL fragments for the oracle side of the correctness check.

Each registered query has an independent SQL formulation over the raw test
tables; these are the shared pieces (views of SURVEY section 2.0).
"""

from __future__ import annotations

from opinio.functions.stopwords import bundled_stop_words, sql_in_list

LETTERS = r"regexp_extract_all(lower({t}), '(\p{{L}}+)', 1)"


def letters(t: str) -> str:
    return LETTERS.format(t=t)


def ws_tokens(t: str) -> str:
    trimmed = rf"regexp_replace(lower({t}), '\s+$', '')"
    return (f"CASE WHEN {trimmed} = '' AND length({t}) > 0 THEN []::VARCHAR[] "
            rf"ELSE regexp_split_to_array({trimmed}, '\s') END")


def bucket(key: str, buckets: int = 100) -> str:
    return (f"CAST((('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8))::BIGINT)"
            f" % {buckets} AS INTEGER)")


def split_of(key: str) -> str:
    b = bucket(key)
    return (f"CASE WHEN {b} < 60 THEN 'train' WHEN {b} < 90 THEN 'validation' "
            f"ELSE 'test' END")


STOPS = sql_in_list(bundled_stop_words("english"))

LEXICON_CTE = f"""lex AS (
  SELECT word,
         CASE WHEN ascii(substr(md5(word), 1, 1)) < 56 THEN 1 ELSE -1 END AS sentiment
  FROM (SELECT DISTINCT unnest({letters('text')}) AS word FROM documents) w
  WHERE substr(md5(word), 2, 1) IN ('0', '1', '2', '3'))"""

REVIEWS_CTE = """reviews AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

RATINGS_BODY = f"""
  SELECT l_orderkey, l_linenumber AS line, l_suppkey,
         CAST(l_quantity AS DOUBLE) AS l_quantity,
         CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
         nullif(l_discount, 0.0) AS l_discount,
         nullif(l_tax, 0.0) AS l_tax,
         CAST(l_linenumber AS DOUBLE) AS l_linenumber,
         CAST(o_totalprice AS DOUBLE) AS o_totalprice,
         CAST(p_size AS DOUBLE) AS p_size,
         CAST(p_retailprice AS DOUBLE) AS p_retailprice,
         CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS label,
         {split_of('l_orderkey')} AS split
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN part ON l_partkey = p_partkey"""

RATINGS_CTE = f"ratings AS ({RATINGS_BODY}\n  WHERE l_returnflag IN ('R', 'A'))"
RATINGS_ALL_CTE = f"ratings_all AS ({RATINGS_BODY})"


def sig(x: str, digits: int = 7) -> str:
    """Round to significant digits, same formula as functions.significant."""
    e = f"floor(log10(abs({x})))"
    return (f"CASE WHEN {x} = 0 THEN 0.0 "
            f"WHEN {e} < 0 THEN round({x} * pow(10.0, -{e}), {digits - 1}) / pow(10.0, -{e}) "
            f"ELSE round({x} / pow(10.0, {e}), {digits - 1}) * pow(10.0, {e}) END")


# ------------------------------------------------- least squares by chain ----
# OLS without matrices: regress the label and every remaining feature on one
# feature (regr_slope / regr_intercept over the fit split), keep residuals for
# all rows, repeat with the next feature. After the last feature the label
# column holds the OLS residual (Frisch-Waugh-Lovell), for fit and score rows.

def residual_chain(prefix: str, src: str, regress_on: list[str],
                   carry: list[str], fit_split: str,
                   keep: tuple[str, ...] = ()) -> tuple[list[str], str]:
    ctes, cur = [], src
    remaining = list(regress_on)
    step = 0
    while remaining:
        x, rest = remaining[0], remaining[1:]
        targets = ["y"] + rest + list(carry)
        s, r = f"{prefix}_s{step}", f"{prefix}_r{step}"
        fits = ", ".join(f"regr_slope({t}, {x}) AS b_{t}, regr_intercept({t}, {x}) AS a_{t}"
                         for t in targets)
        ctes.append(f"{s} AS (SELECT {fits} FROM {cur} WHERE split = '{fit_split}')")
        res = ", ".join(f"{cur}.{t} - ({s}.a_{t} + {s}.b_{t} * {cur}.{x}) AS {t}"
                        for t in targets)
        passed = "".join(f"{cur}.{k}, " for k in keep)
        ctes.append(f"{r} AS (SELECT {cur}.split, {passed}{res} FROM {cur}, {s})")
        cur, remaining, step = r, rest, step + 1
    return ctes, cur


def filled_ratings_cte(features: list[str], name: str = "filled") -> str:
    """Labelled ratings, discount/tax NULLs filled with training means."""
    cols = []
    for f in features:
        if f in ("l_discount", "l_tax"):
            cols.append(f"coalesce({f}, (SELECT avg({f}) FROM ratings "
                        f"WHERE split = 'train')) AS {f}")
        else:
            cols.append(f)
    return (f"{name} AS (SELECT l_orderkey, line, l_suppkey, split, label, "
            f"CAST(label AS DOUBLE) AS y, {', '.join(cols)} FROM ratings)")


def subset_mse_sql(runs: list[tuple[list[str], str, str]]) -> str:
    feats = sorted({f for fs, _, _ in runs for f in fs})
    ctes = [RATINGS_CTE, filled_ratings_cte(feats)]
    selects = []
    for n, (fs, fit_on, score_on) in enumerate(runs, start=1):
        chain, last = residual_chain(f"run{n}", "filled", fs, [], fit_on)
        ctes += chain
        selects.append(
            f"SELECT {n} AS run, '{','.join(fs)}' AS features, "
            f"'{fit_on}' AS fit_on, '{score_on}' AS score_on, "
            f"(SELECT count(*) FROM filled WHERE split = '{fit_on}') AS n_fit, "
            f"count(*) AS n_score, round(avg(y * y), 6) AS mse "
            f"FROM {last} WHERE split = '{score_on}'")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(selects)


def ols_coefficients_sql(features: list[str], fit_split: str = "train") -> str:
    ctes = [RATINGS_CTE, filled_ratings_cte(features)]
    slopes = []
    for j, f in enumerate(features):
        others = [g for g in features if g != f]
        chain, last = residual_chain(f"c{j}", "filled", others, [f], fit_split)
        ctes += chain
        ctes.append(f"k{j} AS (SELECT regr_slope(y, {f}) AS b FROM {last} "
                    f"WHERE split = '{fit_split}')")
        slopes.append(f"(SELECT b FROM k{j})")
    means = ", ".join(f"avg({f}) AS m_{f}" for f in features)
    ctes.append(f"mu AS (SELECT avg(y) AS m_y, {means} FROM filled "
                f"WHERE split = '{fit_split}')")
    icpt = "m_y - (" + " + ".join(
        f"{s} * m_{f}" for s, f in zip(slopes, features)) + ")"
    rows = [f"SELECT '{f}' AS \"column\", {sig(s)} AS weight"
            for f, s in zip(features, slopes)]
    rows.append(f"SELECT 'intercept' AS \"column\", {sig('(' + icpt + ')')} AS weight FROM mu")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(rows)


def ols_mse_sql(features: list[str], fit_split: str, score_split: str) -> str:
    ctes = [RATINGS_CTE, filled_ratings_cte(features)]
    chain, last = residual_chain("m", "filled", features, [], fit_split)
    ctes += chain
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT round(avg(y * y), 6) AS mse FROM {last} "
            f"WHERE split = '{score_split}'")


def ols_preview_sql(features: list[str], fit_split: str, score_split: str,
                    k: int = 20) -> str:
    """Predictions (label - OLS residual) of the first ``k`` negatives."""
    ctes = [RATINGS_CTE, filled_ratings_cte(features)]
    chain, last = residual_chain("p", "filled", features, [], fit_split,
                                 keep=("l_orderkey", "line", "l_suppkey", "label"))
    ctes += chain
    return ("WITH " + ",\n".join(ctes) +
            f"\nSELECT l_orderkey, line, l_suppkey, round(label - y, 6) + 0.0 AS prediction, "
            f"label FROM {last} WHERE split = '{score_split}' AND label = 0 "
            f"ORDER BY l_orderkey, line LIMIT {k}")
