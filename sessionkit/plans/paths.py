"""End-to-end paths: the reference's four scripts as Spark jobs.

* ``process_sessions``  events -> model-ready sessions (Parquet) + class balance;
* ``run_bakeoff``        resumable default bake-off, top-2 grid search, leaderboard CSV;
* ``train_champion``     champion pipeline (scaler inside), saved, with importances;
* ``segment_sessions``   sessions -> features -> k-means -> stats, names, reports.

Intermediate tables that later steps read several times are written to the
shared checkpoint folder (lineage cuts); outputs go to the given folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import segments as SG
from ..operators import sessions as S
from ..session import materialize
from ..sources import io as IO
from . import models as M
from . import report as RP


def convert_monthly_csv(spark: SparkSession, files: dict[str, str], output_path: str,
                        narrow: bool = True) -> list[tuple[str, str, str]]:
    """Step 1 as one batch job: every monthly CSV (``{month: path}``) read with
    the declared layout, numeric columns narrowed by one whole-table pass,
    written as snappy Parquet partitioned by ``source_month``.  Returns the
    narrowing decisions (column, old type, new type)."""
    months = [IO.read_monthly_csv(spark, path, month) for month, path in files.items()]
    # ids over the union: its partitions keep the files' order, so the ids
    # follow file order across months too (per-file ids would collide)
    events = S.union_months(*months).withColumn("event_id", F.monotonically_increasing_id())
    decisions: list[tuple[str, str, str]] = []
    if narrow:
        events, decisions = IO.narrow_types(events)
    IO.write_parquet(events, output_path, ["source_month"])
    return decisions


def label_events(events: DataFrame, output_path: str) -> DataFrame:
    """The notebook's first output: valid events with their session's
    abandoned flag (W1), written as Parquet and read back."""
    IO.write_parquet(S.labeled_events(S.valid_events(events)), output_path)
    return events.sparkSession.read.parquet(output_path)


def process_sessions(events: DataFrame, output_path: str) -> DataFrame:
    """PROC main: writes the model-ready table, returns the class balance."""
    IO.write_parquet(S.build_model_ready(events), output_path)
    ready = events.sparkSession.read.parquet(output_path)
    return P.value_share(ready, S.LABEL, pct=False)


def run_bakeoff(spark: SparkSession, model_ready_path: str, results_dir: str,
                tune_top: int = 2, parallelism: int = 4) -> DataFrame:
    """BAKE main: resumable; a rerun skips every model already logged."""
    data = M.Prepared(spark.read.parquet(model_ready_path))
    log = f"{results_dir.rstrip('/')}/running_results"
    M.bakeoff(spark, data, log, tune_top=tune_top, parallelism=parallelism)
    board = RP.leaderboard(spark, log)
    RP.write_csv_report(board, f"{results_dir.rstrip('/')}/all_model_results")
    data.unpersist()
    return board


def train_champion(spark: SparkSession, model_ready_path: str, results_dir: str,
                   params: dict | None = None) -> DataFrame:
    """CHAMP main: fit, save the whole pipeline, report importances."""
    data = M.Prepared(spark.read.parquet(model_ready_path))
    model = M.fit_champion(data, params)
    model.save(spark, f"{results_dir.rstrip('/')}/champion_pipeline")
    imp = M.feature_importance(model, data.features, spark)
    RP.write_csv_report(imp, f"{results_dir.rstrip('/')}/champion_feature_importance")
    data.unpersist()
    return imp


def segment_sessions(events: DataFrame, results_dir: str, k: int = SG.N_CLUSTERS,
                     n_init: int = 10, max_iter: int = 100) -> dict[str, DataFrame]:
    """CLUS main: exact sessions over both months, clustering features,
    k-means, per-cluster analysis, names, and the saved outputs."""
    out = results_dir.rstrip("/")
    feats = materialize(SG.segment_features(S.segment_sessions(S.valid_events(events))))
    matrix = materialize(SG.cluster_matrix(feats))
    model, _ = SG.fit_kmeans(matrix, k=k, n_init=n_init, max_iter=max_iter)
    clustered = materialize(SG.kmeans_segments(matrix, model).drop(*SG.zcols()))
    analysis = SG.cluster_analysis(clustered).persist()
    names = SG.cluster_names(analysis).persist()
    named = SG.named_sessions(clustered, names)
    IO.write_parquet(named, f"{out}/session_clusters_with_names")
    RP.write_csv_report(SG.cluster_summary(named), f"{out}/cluster_analysis_detailed")
    RP.write_csv_report(names.orderBy("cluster_id"), f"{out}/cluster_names_mapping")
    return {"analysis": analysis, "names": names, "sessions": named,
            "risk": SG.cluster_risk(analysis),
            "cards": SG.cluster_cards(analysis, names)}


def events_from(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """Event table from Parquet (optionally some ``source_month`` partitions)."""
    df = IO.read_parquet(spark, path, months)
    if "event_time" in df.columns:
        df = df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return df
