"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (the full plan
executes, nothing is collected).  value = sum of per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["top_ngrams_by_class", "clean_reviews", "length_summary", "length_histogram", "duplicates",
            "cloud_terms", "vocab_stats", "split_exact", "tfidf", "bow", "text_stats_scaled", "vocab_by_freq",
            "encode_sequences", "metrics_basic", "roc_auc", "roc_curve", "class_report", "regression_metrics",
            "strip_html", "length_kde", "nb_predictions", "stats_regressions"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from reviewlens.session import build_session
    from reviewlens.plans.catalog import QUERIES

    spark = build_session(f"local[{cpus}]", int(cpus), app_name="reviewlens-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    names = sys.argv[1:] or HEADLINE
    # Warm-up (not timed): JVM start, class loading, JIT and codegen for every headline query, on the
    # smallest scale factor next to $BENCH_SF_DIR (or $BENCH_WARM_DIR), so each timing is steady state.
    warm = os.environ.get("BENCH_WARM_DIR") or os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm):
        warm = sf_dir
    for name in names:
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
