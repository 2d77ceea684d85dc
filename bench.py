"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion through the no-op sink (the whole plan
executes, nothing is collected) and timed on the driver clock.  Model keys
time their fit + test-set prediction, the span the reference reports.
Within the one application, keys share the intermediate tables a single
run of the reference's scripts shares (prepared training data, the fitted
segmentation matrix); the first key that needs one pays for it.
``BENCH_ALONE=1`` forgets the shared tables before each key, so that each
pays for all it needs.  Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sessionkit.plans.catalog import QUERIES, release  # noqa: E402
from sessionkit.session import build_session  # noqa: E402

HEADLINE = [
    "model_ready", "enriched_sessions", "segment_sessions", "labeled_events",
    "returning_users_join", "distinct_counts", "describe_price", "price_kde",
    "low_cardinality", "kmeans_assign", "cluster_names", "split_70_30",
    "classification_report", "model_lr", "model_rf", "model_gbt", "model_gbt_leafcapped",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus, extra={
        "sessionkit.inputPartitions": str(cpus), "sessionkit.trainPartitions": str(cpus)})
    # warm-up (untimed): JVM start and JIT, on the smallest driver tables
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for key in ("clean_counts", "model_ready"):
        QUERIES[key](spark, warm_dir if os.path.isdir(warm_dir) else sf_dir) \
            .write.format("noop").mode("overwrite").save()
    times = {}
    for key in keys:
        if os.environ.get("BENCH_ALONE"):
            release(spark)
        t0 = time.time()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    release(spark)
    spark.stop()


if __name__ == "__main__":
    main()
