"""The cleaning chain on an airline-layout CSV written by hand."""

import csv
import os
import tempfile

import pytest

from opinio.plans.regression import ols_subset_report
from opinio.plans.reviews import load_reviews, model_ready
from opinio.specs import AIRLINE, AIRLINE_COLUMNS, AIRLINE_FILL_MEANS


def _write(rows, header=True):
    d = tempfile.mkdtemp(prefix="opinio-airline-")
    path = os.path.join(d, "airline.csv")
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        if header:
            w.writerow(AIRLINE_COLUMNS)
        w.writerows(rows)
    return path


def _row(i, overall, label, content="fine flight"):
    r = [f"air{i % 3}", f"/r/{i}", "t", "a", "uk", "2015-01-01", content,
         "A320", "Solo", "Economy", "X-Y", overall] + [str((i + k) % 5 + 1) for k in range(7)]
    return r + [label]


def test_load_reviews_cleans_like_the_reference(spark):
    rows = [_row(1, "7", "1", 'said "great"\nand left'), _row(2, "bad", "1.0"),
            _row(3, "", "0"), _row(4, "5.0", ""), _row(5, "3", "recommended")]
    df = load_reviews(spark, _write(rows))
    got = {r.link: (r.overall_ratingf, r.recommendedi, r.content) for r in df.collect()}
    assert got == {"/r/1": (7.0, 1, 'said "great"\nand left'),
                   "/r/2": (None, 1, "fine flight"), "/r/3": (None, 0, "fine flight")}
    assert "overall_rating" not in df.columns and "recommended" not in df.columns
    assert set(AIRLINE.rating_cols) <= set(df.columns)


def test_headerless_read_drops_header_line_by_label_filter(spark):
    path = _write([_row(1, "7", "1"), _row(2, "8", "0")], header=True)
    df = load_reviews(spark, path, header=False)
    assert sorted(r.link for r in df.collect()) == ["/r/1", "/r/2"]


def test_airline_ols_report_runs_all_13(spark):
    rows = [_row(i, str(i % 10 + 1), str(i % 2)) for i in range(300)]
    df = load_reviews(spark, _write(rows))
    ready = model_ready(df, AIRLINE, constants=AIRLINE_FILL_MEANS)
    rep = ols_subset_report(spark, ready, AIRLINE).collect()
    assert [r.run for r in rep] == list(range(1, len(AIRLINE.ols_runs) + 1))
    assert all(r.mse is not None and r.mse >= 0 for r in rep)
    ready2 = model_ready(df, AIRLINE)
    assert ready2.where("overall_ratingf IS NULL").count() == 0


def test_airport_layout(spark):
    from opinio.specs import AIRPORT, AIRPORT_COLUMNS
    d = tempfile.mkdtemp(prefix="opinio-airport-")
    path = os.path.join(d, "airport.csv")
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(AIRPORT_COLUMNS)
        base = ["dubai-airport", "/a/1", "t", "a", "uk", "2015", "long queue", "transit",
                "2015-05", "Solo"]
        w.writerow(base + ["4", "3", "x", "5", "", "2", "1", "1", "3", "0"])
        w.writerow(base[:1] + ["/a/2"] + base[2:] + ["9"] * 9 + ["1"])
    df = load_reviews(spark, path, AIRPORT_COLUMNS, AIRPORT)
    got = {r.link: (r.queuing_ratingf, r.terminal_cleanliness_ratingf, r.recommendedi)
           for r in df.collect()}
    assert got == {"/a/1": (3.0, None, 0), "/a/2": (9.0, 9.0, 1)}
    assert len(AIRPORT.rating_cols) == 9
    assert all(f.endswith(".parquet") for f in df.inputFiles())


def test_airport_ols_runs_by_column_name(spark):
    from opinio.specs import AIRPORT
    rows = [(i, float(i % 7), float(i % 5), i % 2, "train" if i % 3 else "validation") for i in range(200)]
    df = spark.createDataFrame(rows, "key int, airport_staff_ratingf double, queuing_ratingf double, "
                                     "recommendedi int, split string")
    runs = [(("airport_staff_ratingf",), "train", "validation"),
            (("airport_staff_ratingf", "queuing_ratingf"), "train", "train")]
    rep = ols_subset_report(spark, df, AIRPORT, runs).collect()
    assert [r.features for r in rep] == ["airport_staff_ratingf", "airport_staff_ratingf,queuing_ratingf"]
    with pytest.raises(ValueError):
        ols_subset_report(spark, df, AIRPORT)


def test_land_writes_once_and_reads_back(spark):
    from conftest import SF_SMALL
    from opinio.plans import views as V
    from opinio.sources import land
    r = V.ratings_split(spark, SF_SMALL)
    landed = land(r, "ratings")
    assert sorted(landed.collect()) == sorted(r.collect())
    assert all(f.endswith(".parquet") for f in landed.inputFiles())
