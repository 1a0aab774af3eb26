"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS], forcing full evaluation with the ``noop`` sink (no
collect to the driver), and prints ONE JSON line:

    {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is timed $BENCH_REPS times (default 3) after one warm-up run;
the reported time is the median.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "lexicon_entity_sentiment",
    "lexicon_accuracy",
    "token_lexicon_join",
    "tokenize_letters",
    "term_counts",
    "pruned_vocabulary",
    "idf_weights",
    "tfidf",
    "top_bottom_words",
    "csv_review_scan",
    "impute_mean",
    "rating_means",
    "entity_mean_2se",
    "busy_entities",
    "split_counts",
    "assemble_ratings",
    "subset_mse_report",
    "ols_coefficients",
    "mse",
    "auc",
    "ratings_logreg",
    "ratings_random_forest",
    "text_elastic_net",
    "grid_search",
    "entity_report",
    "score_all",
    "word_weights",
    "word_weight_extremes",
    "weight_sparsity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE

    from opinio.catalog import QUERIES
    from opinio.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="opinio-bench")

    def run(name: str) -> float:
        # no reuse of frames a previous run persisted: every run recomputes
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    times: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up: JIT, file listing, broadcast of small tables
        samples = [run(name) for _ in range(max(1, reps))]
        times[name] = round(statistics.median(samples), 3)
        print(f"# {name}: {times[name]}s {[round(s, 2) for s in samples]}",
              file=sys.stderr, flush=True)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))


if __name__ == "__main__":
    main()
