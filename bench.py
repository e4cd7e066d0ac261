"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
Each query is forced with a ``noop`` write so the whole plan executes
without collecting rows to the driver.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "prepare_split_summary", "null_pct", "corr_matrix", "missing_mechanism", "iqr_clip",
    "stratified_split", "clean_text", "tfidf", "bow", "lexical_rule", "ks_drift", "js_text_drift",
    "kmeans_assign", "class_report", "leaderboard", "validate_requests", "imputer_rmse",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from cribble.plans.registry import load_all
    from cribble.session import local_session

    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 16,
                          app="cribble-bench")
    reg = load_all()
    names = [n for n in HEADLINE if n in reg]
    times: dict[str, float] = {}
    # warm-up: JVM start and first-scan costs are not part of any query
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    for name in names:
        t0 = time.time()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
