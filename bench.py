"""Time the headline queries; prints one JSON line. ``BENCH_SF_DIR``, ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "moderated_t_lines",
    "moderated_t",
    "moderated_t_vectors",
    "pearson_by_feature",
    "bh_by_group",
    "select_fallback_two_vector_9",
    "logit_by_feature",
    "align_inner",
    "unpivot_wide",
    "pivot_long",
    "impute_median",
    "strat_folds",
    "repeated_folds",
    "auc_ranksum",
    "threshold_sweep",
    "pr_areas",
    "class_report",
    "standardize",
    "rose_balance",
    "binned_mi",
    "rf_importance",
    "rfe_fixed",
    "train_logistic_lines",
    "train_gbt",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from phenoloom.plans.catalogue import QUERIES
    from phenoloom.session import local_session

    spark = local_session(cpus, "bench", int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # warm the JVM
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        begun = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - begun, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": timings, "sf": os.path.basename(sf_dir).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
