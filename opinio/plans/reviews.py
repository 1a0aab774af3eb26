"""Review files -> cleaned, labelled, split table.

The reference's cleaning chain as one function per layout: read the CSV
(quoted multi-line text, header row not taken as data), cast the rating
columns leniently to ``<name>f`` doubles, cast the label via double, drop
the string originals, keep rows labelled 0 or 1 -- one scan, no self-union.
Files are read in byte ranges (``sources.csv_split``); the cleaned table is written once
to the shared folder and later jobs scan that copy.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.operators import clean
from opinio.operators.split import hash_split
from opinio.sources.csv_split import read_split_csv
from opinio.sources.readers import land
from opinio.specs import AIRLINE, AIRLINE_COLUMNS, ReviewSpec


def load_reviews(spark: SparkSession, path: str,
                 layout: list[str] = AIRLINE_COLUMNS,
                 spec: ReviewSpec = AIRLINE, header: bool = True,
                 label_source: str = "recommended",
                 as_double_label: bool = False,
                 labelled: bool = True, landed: bool = True) -> DataFrame:
    """Cleaned review table. With ``header=False`` the columns are named by
    position (the file's own header line, if any, then fails the label
    cast and is dropped by the label filter). ``landed=False`` leaves the frame
    lazy: every action then parses the file again."""
    raw = read_split_csv(spark, path, layout, header=header)
    ratings = [c for c in layout if c.endswith("_rating")]
    out = clean.cast_lenient(raw, ratings, suffix="f")
    out = clean.cast_label(out, label_source, spec.label_col,
                           as_double=as_double_label)
    out = clean.labelled_only(out, spec.label_col) if labelled else out
    return land(out, "reviews") if landed else out


def model_ready(df: DataFrame, spec: ReviewSpec, split_key: str | None = None,
                constants: Mapping[str, float] | None = None) -> DataFrame:
    """Tag train / validation / test by md5 of ``split_key`` and fill
    missing ratings: with given ``constants`` (the reference's way), else
    with means fitted on the training split only."""
    tagged = hash_split(df, split_key or spec.key_col)
    cols = list(spec.rating_cols)
    if constants is not None:
        return clean.fill_constants(tagged, constants)
    return clean.impute_mean(tagged.where(F.col("split") == "train"), tagged, cols)
