"""Column expressions. All built-in Spark SQL functions: they stay in
whole-stage codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a token is a maximal run of Unicode letters.
LETTER_RUN = r"(\p{L}+)"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_double(c: str | Column) -> Column:
    """String -> double; malformed text becomes NULL instead of failing
    (Spark 4 casts are ANSI and raise)."""
    return _c(c).try_cast("double")


def label_int(c: str | Column) -> Column:
    """String label -> int through double, so ``"1.0"`` is 1; junk and
    out-of-range values NULL (both steps lenient under ANSI)."""
    return _c(c).try_cast("double").try_cast("int")


def letter_tokens(text: str | Column) -> Column:
    """Lower-cased runs of letters; a text without letters gives []."""
    return F.regexp_extract_all(F.lower(_c(text)), F.lit(LETTER_RUN), F.lit(1))


def whitespace_tokens(text: str | Column) -> Column:
    """Lower-case and split on single whitespace characters, like the ML
    ``Tokenizer``: runs of spaces yield empty tokens, trailing empty tokens
    are dropped and an all-whitespace text gives []."""
    low = F.lower(_c(text))
    trimmed = F.regexp_replace(low, r"\s+$", "")
    return (F.when((trimmed == F.lit("")) & (F.length(low) > 0),
                   F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, r"\s", -1)))


def hash_bucket(key: str | Column, buckets: int = 100) -> Column:
    """Deterministic bucket of a key: first 32 bits of md5, mod ``buckets``.
    Independent of partitioning and of task retries."""
    hex8 = F.substring(F.md5(_c(key).cast("string")), 1, 8)
    return (F.conv(hex8, 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def match_flag(a: str | Column, b: str | Column) -> Column:
    """1.0 where two columns are equal, 0.0 where not, NULL if either is."""
    return (_c(a) == _c(b)).cast("double")


def polarity(avg_col: str | Column) -> Column:
    """1.0 for a positive average, else 0.0 (zero and NULL give 0.0)."""
    return F.when(_c(avg_col) > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def two_standard_errors(c: str | Column) -> Column:
    """2 * sample stddev / sqrt(n); NULL for a single value."""
    return 2 * F.stddev_samp(_c(c)) / F.sqrt(F.count(F.lit(1)))


def significant(c: str | Column, digits: int = 7) -> Column:
    """Round to ``digits`` significant digits (for comparing small
    coefficients across engines). Scales only by exact powers of ten."""
    x = _c(c)
    e = F.floor(F.log10(F.abs(x)))
    up = F.pow(F.lit(10.0), -e)     # exact for e < 0
    down = F.pow(F.lit(10.0), e)    # exact for e >= 0
    return (F.when(x == 0, F.lit(0.0))
            .when(e < 0, F.round(x * up, digits - 1) / up)
            .otherwise(F.round(x / down, digits - 1) * down))
