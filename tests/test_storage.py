"""Stored models, node tables of forests and CSV files read in byte ranges."""

import csv
import os
import random
import subprocess
import sys

import numpy as np
import pytest
from conftest import ROOT, SF_MID, SF_SMALL
from pyspark.sql import functions as F

from opinio.catalog import QUERIES, SUB_RATINGS, _labelled_double
from opinio.operators.text import tfidf_estimator, words_of_vectors
from opinio.plans import classify as CL
from opinio.session import scratch_path
from opinio.sources import csv_split, models, readers

# ---- stored models


@pytest.fixture(scope="module")
def forest(spark):
    f = _labelled_double(spark, SF_MID).cache()
    return f, CL.forest_estimator(SUB_RATINGS, "label", seed=3).fit(f.where("split = 'train'"))


def test_versions_rise_and_stay(spark, forest):
    root = scratch_path(spark, "store")
    f, model = forest
    assert models.versions(spark, "m", root).count() == 0
    with pytest.raises(LookupError):
        models.load_model(spark, "m", root=root)
    assert models.save_model(spark, model, "m", root, {"why": "first"}) == 1
    other = CL.logreg_estimator(SUB_RATINGS, "label").fit(f.where("split = 'train'"))
    assert models.save_model(spark, other, "m", root) == 2
    cards = {r.version: r for r in models.versions(spark, "m", root).collect()}
    assert cards[1].notes == {"why": "first"} and cards[1].stages[-1] == "RandomForestClassificationModel"
    for version, want in ((1, model), (2, other), (None, other)):
        back = models.load_model(spark, "m", version, root)
        a, b = (m.transform(f).agg(F.sum("prediction")).first() for m in (want, back))
        assert a == b and back.stages[-1].uid == want.stages[-1].uid
    # a version without its card (its writer died) is not seen
    model.write().save(f"{root}/m/3/model")
    assert models.model_path(spark, "m", root=root).endswith("/2/model")


SECOND = """
import sys
sys.path.insert(0, sys.argv[1])
from opinio.session import local_session
from opinio.sources import models
spark = local_session(2)
model = models.load_model(spark, "t", root=sys.argv[2])
model.transform(spark.read.parquet(sys.argv[3]).where("text is not null")).select("doc_id", "tfidf").write.parquet(sys.argv[4])
"""


def test_stored_pipeline_in_a_second_session(spark):
    root, out = scratch_path(spark, "store"), scratch_path(spark, "scored")
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("text is not null")
    model = tfidf_estimator("text", ["the"]).fit(docs)
    models.save_model(spark, model, "t", root)
    plain = [p.removeprefix("file:") for p in (root, out)]
    subprocess.run([sys.executable, "-c", SECOND, ROOT, plain[0], f"{SF_SMALL}/documents.parquet", plain[1]], check=True,
                   capture_output=True, timeout=180)
    rows = lambda df: sorted(map(tuple, words_of_vectors(df, model, ["doc_id"]).collect()))
    assert rows(spark.read.parquet(out)) == rows(model.transform(docs)) != []


# ---- forests as tables

def test_node_table_scores_every_row_like_the_model(spark, forest):
    f, model = forest
    root = scratch_path(spark, "store")
    models.save_model(spark, model, "f", root)
    nodes = models.forest_nodes(spark, models.model_path(spark, "f", root=root), SUB_RATINGS).cache()
    rf = model.stages[-1]
    assert nodes.count() == rf.totalNumNodes and nodes.select("tree").distinct().count() == rf.getNumTrees
    assert nodes.agg(F.max("depth")).first()[0] == max(t.depth for t in rf.trees)
    both = CL.positive_probability(model.transform(CL.forest_scores(f, nodes, SUB_RATINGS)), "score")
    worst, wrong, n = both.agg(F.max(F.abs(F.col("score") - F.col("forest_score"))),
                               F.sum((F.col("prediction") != F.col("forest_prediction")).cast("int")), F.count("*")).first()
    assert n == f.count() and worst < 1e-12 and wrong == 0
    got = {r.column: r.weight for r in CL.gain_importances(nodes, SUB_RATINGS).collect()}
    assert np.allclose([got[c] for c in SUB_RATINGS], rf.featureImportances.toArray(), atol=1e-12)


def test_a_forest_stored_alone(spark, forest):
    root = scratch_path(spark, "store")
    models.save_model(spark, forest[1].stages[-1], "alone", root)
    nodes = models.forest_nodes(spark, models.model_path(spark, "alone", root=root), SUB_RATINGS)
    assert nodes.count() == forest[1].stages[-1].totalNumNodes
    assert models.load_model(spark, "alone", root=root).getNumTrees == 20


def test_rf_queries_agree(spark):
    a = {r.column: r.weight for r in QUERIES["rf_importances"](spark, SF_SMALL).collect()}
    b = {r.column: r.weight for r in QUERIES["rf_gain_importances"](spark, SF_SMALL).collect()}
    assert b == pytest.approx(a, abs=1e-12)


# ---- CSV in byte ranges

@pytest.fixture(scope="module")
def files(tmp_path_factory):
    rnd = random.Random(1)
    folder = tmp_path_factory.mktemp("csv")
    cells = ["", "a", "x,y", 'q "q" q', "line\nline", "\n\n", '"', '""', "tail\n", '"\n"', "  sp"]
    for j in range(3):
        with open(folder / f"f{j}.csv", "w", newline="", encoding="utf-8") as f:
            w = csv.writer(f, lineterminator="\n")
            w.writerow(["a", "b", "c"])
            for i in range(150):
                cell = lambda: rnd.choice([*cells, "ü" * rnd.randint(0, 40), "long " * rnd.randint(0, 80) + "\n" * rnd.randint(0, 30)])
                w.writerow([f"{j}-{i}", cell(), cell()])
    return str(folder)


@pytest.mark.parametrize("size", [97, 3000])
@pytest.mark.parametrize("few", [True, False])
def test_split_csv_equals_the_whole_file_reader(spark, files, monkeypatch, size, few):
    if not few:
        monkeypatch.setattr(csv_split, "MOST_BROADCAST_RANGES", 0)
    cols = ["a", "b", "c"]
    conf = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in conf}
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        one = f"{files}/f0.csv"
        assert csv_split.physical_lines(spark, one).rdd.getNumPartitions() >= os.path.getsize(one) // size
        got = rows(csv_split.read_split_csv(spark, files, cols))
        plain = rows(csv_split.read_split_csv(spark, one, cols, header=False))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == rows(readers.read_review_csv(spark, files, cols)) and len(got) == 450
    assert len(plain) == 151 and ("a", "b", "c") in plain


def test_split_csv_of_open_quotes_and_empty_files(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"never closed\n')
    with pytest.raises(Exception, match="quotes are not balanced"):
        csv_split.read_split_csv(spark, str(tmp_path / "open.csv"), ["a", "b"]).collect()
    (tmp_path / "empty.csv").write_text("")
    assert csv_split.read_split_csv(spark, str(tmp_path / "empty.csv"), ["a", "b"]).count() == 0
    (tmp_path / "dos.csv").write_bytes(b'a,b\r\n1,"x\ny"\r\n\r\n2,z\r\n')
    assert [tuple(r) for r in csv_split.read_split_csv(spark, str(tmp_path / "dos.csv"), ["a", "b"]).orderBy("a").collect()] \
        == [("1", "x\ny"), ("2", "z")]
