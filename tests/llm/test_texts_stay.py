"""op6's texts are written in buckets of their block: no step shuffles them."""

import re

from opinio.llm import suffix_dedup
from opinio.llm.common import recorded


def test_texts_are_never_shuffled(spark):
    passage = "the same passage in two of the texts, long enough to be found again " * 4
    rows = [(k, f"text number {k} " + (passage if k in (3, 8) else "")) for k in range(20)] + [(20, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with recorded() as paths:
        out = suffix_dedup.remove_repeats(docs)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.doc_id: r.n_removed for r in out.collect()}
    assert got == {k: 0 if k not in (3, 8) else got[3] for k in [*range(21), None]} and got[3] >= len(passage) - 1
    scans = [x for x in plan.splitlines() if "FileScan" in x and "suffix_rows" in x]
    assert len(scans) == 2 and all("Bucketed: true" in x for x in scans)
    # above a scan of texts there are only projections, sorts and the cogroup itself
    lines = plan.splitlines()
    for x in scans:
        at = depth = lines.index(x)
        depth = re.search(r"[A-Z]", x).start()
        while "FlatMapCoGroups" not in lines[at]:
            at -= 1
            if re.search(r"[A-Z]", lines[at]).start() < depth:
                depth = re.search(r"[A-Z]", lines[at]).start()
                assert "Exchange" not in lines[at]
    assert any("suffix-rows" in p for p in paths)  # a pipeline stage can remove them
