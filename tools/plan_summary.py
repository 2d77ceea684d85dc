"""Summarise the physical plan of each registered query (non-ML keys).

    python tools/plan_summary.py [sf_dir] > PLANS.md

Per key: shuffles (Exchange), broadcasts, windows, Expand (distinct
rewrite), cartesian products, and whether the event scan received pushed
filters.  Plans are read from the planned query; nothing is executed beyond what a query
does when it is built (fits, lineage cuts).  Every table that a query cuts on
the way has a row of its own under the query's (``key > table``), so no shuffle
hides behind a written table.  Keys run alone: shared tables are forgotten
before each.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sessionkit import session  # noqa: E402
from sessionkit.plans.catalog import QUERIES, release  # noqa: E402
from sessionkit.session import build_session  # noqa: E402

ML_KEYS = {"model_lr", "model_rf", "model_gbt", "model_gbt_leafcapped", "bakeoff", "leaderboard",
           "grid_search", "random_search", "feature_importance", "champion_score",
           "kmeans_segments", "notebook_models", "resume_pending", "bakeoff_confusion",
           "bakeoff_support", "importance_total", "kmeans_nearest"}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("| key | shuffles | broadcasts | windows | expand | cartesian | pushed filters on events |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    cuts: list = []
    session.CUT_WATCHERS.append(lambda name, df: cuts.append((name, plan_text(df))))
    for key, fn in QUERIES.items():
        if key in ML_KEYS:
            continue
        release(spark)
        cuts.clear()
        last = plan_text(fn(spark, sf))
        for name, p in [(key, last), *((f"{key} > {n}", t) for n, t in cuts)]:
            print(row(name, p), flush=True)
    spark.stop()


def row(key: str, p: str) -> str:
    shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                              r"Exchange SinglePartition|Exchange RoundRobin", p))
    bcast = p.count("BroadcastExchange")
    windows = len(re.findall(r"\bWindow \[", p))
    expand = p.count("Expand [")
    cart = p.count("CartesianProduct") + p.count("BroadcastNestedLoopJoin")
    pushed = "yes" if "Not(EqualTo(event_type,error))" in p else "-"
    return f"| {key} | {shuffles} | {bcast} | {windows} | {expand} | {cart} | {pushed} |"


if __name__ == "__main__":
    main()
