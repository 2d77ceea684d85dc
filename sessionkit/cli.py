"""Command line: ``python -m sessionkit.cli <step> ...``.

Steps: ``ingest`` (CSV drops -> Parquet table), ``process`` (events ->
model-ready sessions), ``bakeoff``, ``champion``, ``segment``.  Events come
from a Parquet table (``--events``) or from a driver scale-factor folder
through the adapter (``--sf-dir``).  Run under ``spark-submit`` on a cluster;
the session's own settings (including ``spark.checkpoint.dir``) are used.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import paths
from .session import ensure_checkpoint_dir
from .sources.adapter import load_events
from .streaming.ingest import ingest_csv


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="sessionkit")
    ap.add_argument("step", choices=["ingest", "process", "bakeoff", "champion", "segment"])
    ap.add_argument("--events", help="Parquet event table")
    ap.add_argument("--sf-dir", help="driver scale-factor folder (adapter)")
    ap.add_argument("--csv-dir", help="CSV drop folder (ingest)")
    ap.add_argument("--model-ready", help="model-ready Parquet table")
    ap.add_argument("--out", required=True, help="output table or results folder")
    ap.add_argument("--no-tune", action="store_true")
    ap.add_argument("--monthly-csv", action="store_true",
                    help="ingest: files in the public monthly layout (month from file name)")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"sessionkit-{args.step}").getOrCreate()
    ensure_checkpoint_dir(spark)

    def events():
        return (load_events(spark, args.sf_dir) if args.sf_dir
                else paths.events_from(spark, args.events))

    if args.step == "ingest":
        # the stream checkpoint sits next to the table so reruns resume
        ingest_csv(spark, args.csv_dir, args.out, f"{args.out.rstrip('/')}_checkpoint",
                   monthly_layout=args.monthly_csv)
    elif args.step == "process":
        paths.process_sessions(events(), args.out).show()
    elif args.step == "bakeoff":
        paths.run_bakeoff(spark, args.model_ready, args.out,
                          tune_top=0 if args.no_tune else 2).show(truncate=False)
    elif args.step == "champion":
        paths.train_champion(spark, args.model_ready, args.out).show()
    else:
        res = paths.segment_sessions(events(), args.out)
        res["names"].orderBy("cluster_id").show(truncate=False)


if __name__ == "__main__":
    main()
