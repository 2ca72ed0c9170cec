"""Benchmark: the reference's end-to-end run and its experiment workloads at
$BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskspark.session import build_session  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    from riskspark.plans import end_to_end
    from riskspark.queries import catalog

    timings = {}

    def timed(name, fn):
        t0 = time.time()
        fn()
        timings[name] = round(time.time() - t0, 3)

    # the reference's run: clean, 80/20 holdout, 5-fold logistic GD 400 steps, 100 thresholds,
    # fold averaging, holdout metrics, test predictions written as CSV
    timed("end_to_end", lambda: end_to_end.run(spark, sf_dir, steps=400, gamma=0.7, search=100))
    for name in ("null_profile", "auto_type", "recode_chain", "add_intercept", "scale_fit", "gram_matrix",
                 "threshold_search", "exact_holdout", "undersample", "cross_validate", "degree_sweep",
                 "rate_sweep", "ablation"):
        # the noop sink runs the whole plan without shipping result rows to Python
        timed(name, lambda n=name: catalog.QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(sum(timings.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
