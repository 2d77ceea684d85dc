"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator key of the blueprint.  Each reads the driver tables (through the
event adapter) so its work grows with the data; doubles of keys checked
with rounding ("R" keys) are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import seconds_between
from ..operators import profile as P
from ..operators import segments as SG
from ..operators import kmeans as KM
from ..operators import sessions as S
from ..operators.session_state import SessionState
from ..operators.user_store import store_by_user
from ..session import delete_scratch, folder_size, folder_state, materialize, scratch_path
from ..sources import io as IO
from ..sources.adapter import load_events
from ..sources.schema import EVENT_COLUMNS
from ..streaming.ingest import ingest_csv, reject_counts
from . import models as M
from . import prep as PR
from . import report as RP
from . import tuning as TU

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str):
    def deco(fn):
        QUERIES[key] = fn
        return fn
    return deco


_SHARED: dict = {}


def _shared(spark, sf, what, build):
    """Per-application memo, tied to the state of the input files: the split/scaled training data and the trained
    champion are built once and shared by the model keys, as the reference
    prepares its data once per script and trains every model on it."""
    state = tuple(folder_state(spark, f"{sf.rstrip('/')}/{t}.parquet") for t in ("events", "part"))
    key = (spark.sparkContext.applicationId, sf, state, what)
    if key not in _SHARED:
        _SHARED[key] = build()
    return _SHARED[key]


def release(spark: SparkSession) -> None:
    """Forget the shared tables of this application, drop what it has cached
    and delete its scratch tables.  Results read after this are lost."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SHARED if k[0] == app]:
        if isinstance(held := _SHARED.pop(key), M.Prepared):
            held.unpersist()
    for df in _CACHED.pop(app, []):
        df.unpersist()
    delete_scratch(spark)


_CACHED: dict[str, list] = {}


def _cached(df: DataFrame) -> DataFrame:
    """A small table that a key reads more than once; dropped by ``release``."""
    _CACHED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(df.persist())
    return df


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every float/double column (R keys)."""
    return df.select([
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


#: The event columns that need no product table.
OWN_COLUMNS = [c for c in EVENT_COLUMNS if c not in ("brand", "category_code")]


def _events(spark, sf, columns=None, **kw):
    """The events of the folder; the session's ``sessionkit.inputPartitions``
    (unset: the input's own splits) deals a small input over the cores."""
    n = spark.conf.get("sessionkit.inputPartitions", None)
    return load_events(spark, sf, columns=columns, partitions=int(n) if n else None, **kw)


def _valid(spark, sf, columns=None, require_session=True, **kw):
    return S.valid_events(_events(spark, sf, columns, valid_only=True, **kw), require_session)


#: Bytes of the event files for each task of a session roll-up.
ROLL_UP_BYTES = 4 << 20


def _tasks(spark, sf) -> int:
    """Tasks of a session roll-up: by the size of the event files, so that a
    task's share of the events does not grow with them."""
    size = folder_size(spark, f"{sf.rstrip('/')}/events.parquet")
    return max(spark.sparkContext.defaultParallelism, -(-size // ROLL_UP_BYTES))


# ----------------------------------------------------------------- sessions
@register("model_ready")
def q_model_ready(spark, sf):
    return round_doubles(S.build_model_ready(_events(spark, sf, valid_only=True),
                                             partitions=_tasks(spark, sf)))


TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_text(c: str):
    """Timestamps leave queries as fixed-format text (engine-neutral hashing)."""
    return F.date_format(F.col(c), TS_FMT).alias(c)


def _events_out(df):
    return df.select(*[ts_text(c) if c == "event_time" else F.col(c) for c in df.columns])


@register("valid_events")
def q_valid_events(spark, sf):
    return _events_out(_valid(spark, sf))


@register("labeled_events")
def q_labeled_events(spark, sf):
    lab = S.labeled_events(_valid(spark, sf, ["event_id", S.SESSION, "event_type", "price"]))
    return lab.select("event_id", "user_session", "event_type", "is_abandoned")


@register("event_type_pivot")
def q_event_type_pivot(spark, sf):
    return S.event_type_pivot(_valid(spark, sf, OWN_COLUMNS))


@register("basic_sessions")
def q_basic_sessions(spark, sf):
    return round_doubles(S.basic_sessions(_valid(spark, sf, OWN_COLUMNS)))


def _session_times_out(df):
    return df.select(*[ts_text(c) if c in ("session_start", "session_end") else F.col(c)
                       for c in df.columns])


@register("enriched_sessions")
def q_enriched_sessions(spark, sf):
    return round_doubles(_session_times_out(S.enriched_sessions(_valid(spark, sf), by_month=True, partitions=_tasks(spark, sf))))


@register("enriched_sessions_eda")
def q_enriched_sessions_eda(spark, sf):
    s = S.enriched_sessions(_valid(spark, sf), by_month=False, keep_times=False,
                            partitions=_tasks(spark, sf))
    return round_doubles(s.drop("user_id"))


@register("segment_sessions")
def q_segment_sessions(spark, sf):
    return round_doubles(_session_times_out(S.segment_sessions(_valid(spark, sf), partitions=_tasks(spark, sf))))


@register("segment_sessions_merged")
def q_segment_sessions_merged(spark, sf):
    """The partial sessions of each month stored, then merged."""
    state = SessionState(spark, scratch_path(spark, "session-state"))
    for month in ("A", "B"):
        state.add(_valid(spark, sf).filter(F.col("source_month") == month), month)
    return round_doubles(_session_times_out(state.sessions()))


def _proc_sessions(spark, sf):
    """Per-month sessions, cut from the event scan (written once, read by
    both sides of the per-user join)."""
    return materialize(S.enriched_sessions(_valid(spark, sf), by_month=True, partitions=_tasks(spark, sf)), "sessions")


@register("user_first_session")
def q_user_first_session(spark, sf):
    return S.user_first_session(_proc_sessions(spark, sf)).select(
        "user_id", ts_text("user_first_session_time"))


@register("returning_users")
def q_returning_users(spark, sf):
    """W2 over sessions stored by user: no exchange, hot users apart."""
    stored = store_by_user(S.enriched_sessions(_valid(spark, sf), by_month=True, partitions=_tasks(spark, sf)))
    return stored.returning().select("source_month", "user_session", "user_id", "is_returning_user")


@register("returning_users_join")
def q_returning_users_join(spark, sf):
    r = S.returning_users(_proc_sessions(spark, sf), method="join")
    return r.select("source_month", "user_session", "user_id", "is_returning_user")


@register("join_counts")
def q_join_counts(spark, sf):
    ev = materialize(_valid(spark, sf, OWN_COLUMNS), "valid-events")
    aggs = (ev.groupBy(S.SESSION)
            .agg(F.count_distinct("product_id").alias("products_viewed"),
                 F.max("price").alias("max_price")))
    counts = S.event_type_pivot(ev)
    return round_doubles(S.join_counts(aggs, counts))


@register("union_months")
def q_union_months(spark, sf):
    months = [S.enriched_sessions(_valid(spark, sf, OWN_COLUMNS, month=m),
                                  by_month=True, keep_times=False, partitions=_tasks(spark, sf)) for m in ("A", "B")]
    out = S.union_months(*months)
    return round_doubles(out.select("source_month", S.SESSION, "products_viewed", "num_views",
                                    "num_carts", "num_purchases", "is_abandoned",
                                    "duration_seconds"))


@register("session_duration")
def q_session_duration(spark, sf):
    s = S.segment_sessions(_valid(spark, sf, OWN_COLUMNS), partitions=_tasks(spark, sf))
    return round_doubles(s.select(S.SESSION, seconds_between("session_start", "session_end")
                                  .alias("duration_seconds")))


# ----------------------------------------------------------------- profiling


@register("preview")
def q_preview(spark, sf):
    return _events_out(P.preview(_events(spark, sf), 5))


@register("null_profile")
def q_null_profile(spark, sf):
    return P.null_profile(_events(spark, sf))


@register("distinct_counts")
def q_distinct_counts(spark, sf):
    return P.distinct_counts(_events(spark, sf))


@register("event_share")
def q_event_share(spark, sf):
    return round_doubles(P.value_share(_events(spark, sf, OWN_COLUMNS), "event_type"))


@register("top_brands")
def q_top_brands(spark, sf):
    return P.top_values(_events(spark, sf), "brand", 10)


@register("top_categories")
def q_top_categories(spark, sf):
    return P.top_values(_events(spark, sf), "category_code", 10)


@register("describe_price")
def q_describe_price(spark, sf):
    return round_doubles(P.describe(_events(spark, sf, OWN_COLUMNS), ["price"], cut=False))


@register("describe_price_valid")
def q_describe_price_valid(spark, sf):
    """P7 after the price filter; events without a session count too."""
    return round_doubles(P.describe(_valid(spark, sf, OWN_COLUMNS, require_session=False),
                                    ["price"], cut=False))


@register("zero_price_by_type")
def q_zero_price_by_type(spark, sf):
    return P.zero_price_by_type(_events(spark, sf, OWN_COLUMNS))


@register("clean_counts")
def q_clean_counts(spark, sf):
    return P.clean_counts(_events(spark, sf, OWN_COLUMNS))


@register("price_histogram")
def q_price_histogram(spark, sf):
    return round_doubles(P.histogram(_valid(spark, sf, OWN_COLUMNS, require_session=False),
                                     "price", 50))


@register("price_kde")
def q_price_kde(spark, sf):
    return round_doubles(P.kde(_valid(spark, sf, OWN_COLUMNS, require_session=False),
                               "price", 200))


@register("price_kde_counts")
def q_price_kde_counts(spark, sf):
    """P11 scaled to the counts of the 50-bin histogram it is drawn over."""
    return round_doubles(P.kde(_valid(spark, sf, OWN_COLUMNS, require_session=False),
                               "price", 200, bins=50))


@register("event_funnel")
def q_event_funnel(spark, sf):
    ev = _valid(spark, sf, OWN_COLUMNS, require_session=False)
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), "event_type")


def _model_ready(spark, sf):
    """The model-ready table, written once per application and read by the
    downstream keys (the processing step's output file the modelling
    scripts read).  The ``model_ready`` key itself always recomputes."""
    return _shared(spark, sf, "model_ready", lambda: materialize(
        S.build_model_ready(_events(spark, sf, valid_only=True), partitions=_tasks(spark, sf)), "model-ready"))


@register("class_balance")
def q_class_balance(spark, sf):
    return round_doubles(P.value_share(_model_ready(spark, sf), S.LABEL, pct=False))


@register("class_balance_percent")
def q_class_balance_percent(spark, sf):
    """P13 in the notebook's form: percent of the basic sessions' outcomes."""
    return round_doubles(P.value_share(_basic(spark, sf), S.LABEL, pct=True))


def _basic(spark, sf):
    return S.basic_sessions(_valid(spark, sf, OWN_COLUMNS))


BASIC_FEATURES = PR.BASIC_FEATURES


@register("describe_sessions")
def q_describe_sessions(spark, sf):
    return round_doubles(P.describe(_basic(spark, sf), BASIC_FEATURES))


@register("means_by_outcome")
def q_means_by_outcome(spark, sf):
    return round_doubles(P.means_by(_basic(spark, sf), S.LABEL, BASIC_FEATURES))


# ----------------------------------------------------------------- segmentation


def _segment_features(spark, sf, columns=None):
    return SG.segment_features(S.segment_sessions(_valid(spark, sf, columns), partitions=_tasks(spark, sf)))


@register("segment_features")
def q_segment_features(spark, sf):
    f = _segment_features(spark, sf, OWN_COLUMNS)
    return round_doubles(f.select(S.SESSION, "duration_seconds", "events_per_minute",
                                  "cart_to_view_ratio", "purchase_to_cart_ratio",
                                  "products_per_event"))


@register("log_features")
def q_log_features(spark, sf):
    f = SG.log_features(_segment_features(spark, sf, OWN_COLUMNS), SG.LOG_FEATURES)
    return round_doubles(f.select(S.SESSION, *SG.LOG_FEATURES))


@register("impute_median")
def q_impute_median(spark, sf):
    f = _segment_features(spark, sf).select(
        S.SESSION, *[F.col(c).cast("double").alias(c) for c in SG.CLUSTER_FEATURES])
    return round_doubles(SG.impute_median(materialize(f), SG.CLUSTER_FEATURES))


def _matrix(spark, sf):
    """Session features written once per application (lineage cut), with the
    fitted imputation and scaling applied: shared by every segmentation key,
    as one clustering run reuses its feature table across steps."""
    return _shared(spark, sf, "matrix", lambda: SG.cluster_matrix(
        materialize(_segment_features(spark, sf), "segment-features")))


@register("robust_scale")
def q_robust_scale(spark, sf):
    return round_doubles(_matrix(spark, sf).select(S.SESSION, *SG.zcols()))


def _assigned(spark, sf):
    """K4 on deterministic seed centres: the SQL-checkable clustering."""
    m = _matrix(spark, sf)
    z = SG.zcols()
    return SG.assign_nearest(m, SG.seed_centers(m, SG.N_CLUSTERS, z), z)


@register("kmeans_assign")
def q_kmeans_assign(spark, sf):
    return _assigned(spark, sf).select(S.SESSION, SG.CLUSTER_COL)


def _analysis(spark, sf):
    return SG.cluster_analysis(_assigned(spark, sf))


@register("cluster_analysis")
def q_cluster_analysis(spark, sf):
    return round_doubles(_analysis(spark, sf))


@register("cluster_thresholds")
def q_cluster_thresholds(spark, sf):
    return round_doubles(SG.thresholds_frame(_cached(_analysis(spark, sf))))


@register("cluster_names")
def q_cluster_names(spark, sf):
    return SG.cluster_names(_cached(_analysis(spark, sf)))


@register("named_sessions")
def q_named_sessions(spark, sf):
    assigned = _assigned(spark, sf)
    names = SG.cluster_names(_cached(SG.cluster_analysis(assigned)))
    return SG.named_sessions(assigned, names).select(
        S.SESSION, SG.CLUSTER_COL, "cluster_name", "cluster_description")


@register("cluster_summary")
def q_cluster_summary(spark, sf):
    assigned = materialize(_assigned(spark, sf))
    names = SG.cluster_names(_cached(SG.cluster_analysis(assigned)))
    return round_doubles(SG.cluster_summary(SG.named_sessions(assigned, names)))


@register("cluster_risk")
def q_cluster_risk(spark, sf):
    return round_doubles(SG.cluster_risk(_analysis(spark, sf)))


@register("cluster_bubbles")
def q_cluster_bubbles(spark, sf):
    return round_doubles(SG.cluster_bubbles(_analysis(spark, sf)))


@register("cluster_intensity")
def q_cluster_intensity(spark, sf):
    return round_doubles(SG.cluster_intensity(_analysis(spark, sf)))


@register("cluster_cards")
def q_cluster_cards(spark, sf):
    a = _cached(_analysis(spark, sf))
    return round_doubles(SG.cluster_cards(a, SG.cluster_names(a)))


@register("kmeans_segments")
def q_kmeans_segments(spark, sf):
    m = materialize(_matrix(spark, sf))
    model, _ = SG.fit_kmeans(m)
    return SG.kmeans_segments(m, model).select(S.SESSION, SG.CLUSTER_COL)


@register("kmeans_starts")
def q_kmeans_starts(spark, sf):
    """K3 with its ten starts in shared passes: every session's cluster in the best."""
    m = _matrix(spark, sf)
    z = SG.zcols()
    best = KM.fit_starts(m, z, SG.N_CLUSTERS)[0]
    return SG.assign_nearest(m, best.centers.tolist(), z).select(S.SESSION, SG.CLUSTER_COL)


@register("kmeans_step")
def q_kmeans_step(spark, sf):
    """One Lloyd step from the seed centres: rows, means and cost of each cluster."""
    m = _matrix(spark, sf)
    z = SG.zcols()
    seeds = np.array(SG.seed_centers(m, SG.N_CLUSTERS, z))
    sums = KM.lloyd_sums(KM.vectors(m, z, S.SESSION), [seeds])
    means = [(F.col("sums")[i] / F.col("n")).alias(c) for i, c in enumerate(z)]
    return round_doubles(sums.select(F.col("cluster").alias(SG.CLUSTER_COL), "n", *means, "cost"))


# ----------------------------------------------------------------- machine learning

SPLIT_OUT = ["source_month", S.SESSION, S.LABEL, "split"]


@register("split_70_30")
def q_split_70_30(spark, sf):
    return PR.split_70_30(_model_ready(spark, sf)).select(*SPLIT_OUT)


@register("split_70_15_15")
def q_split_70_15_15(spark, sf):
    return PR.split_70_15_15(_model_ready(spark, sf)).select(*SPLIT_OUT)


@register("split_shapes")
def q_split_shapes(spark, sf):
    s = PR.split_70_15_15(_model_ready(spark, sf))
    return P.split_shapes(s.select(*PR.EDA_FEATURES, S.LABEL, "split"), "split", S.LABEL)


def _train_test(spark, sf):
    s = _shared(spark, sf, "split_70_30",
                lambda: materialize(PR.split_70_30(_model_ready(spark, sf)), "split"))
    return s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")


@register("standard_scale")
def q_standard_scale(spark, sf):
    train, _ = _train_test(spark, sf)
    scaled = PR.fit_standard_scaler(train, PR.MODEL_FEATURES).transform(train)
    return round_doubles(scaled.select("source_month", S.SESSION,
                                       *PR.scaled_names(PR.MODEL_FEATURES)))


@register("class_weights")
def q_class_weights(spark, sf):
    train, _ = _train_test(spark, sf)
    rows = [(mode, int(c), float(w)) for mode in ("balanced", "unbalance")
            for c, w in PR.class_weights(train, S.LABEL, mode).items()]
    counts = train.groupBy(S.LABEL).count()
    # weights are attached to the per-class counts they were derived from
    w = spark.createDataFrame(rows, f"mode string, {S.LABEL} int, weight double")
    return round_doubles(w.join(counts, S.LABEL, "left").select("mode", S.LABEL, "weight", "count"))


def _rule_predictions(spark, sf):
    """A fixed rule (predict abandoned when the session has a cart) on the
    test split: the SQL-checkable predictor for the report operators."""
    _, test = _train_test(spark, sf)
    return test.withColumn("prediction", (F.col("num_carts") > 0).cast("int"))


@register("classification_report")
def q_classification_report(spark, sf):
    return round_doubles(RP.classification_report(_rule_predictions(spark, sf)))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return RP.confusion_matrix(_rule_predictions(spark, sf))


@register("metrics_long")
def q_metrics_long(spark, sf):
    return round_doubles(RP.metrics_long(_rule_predictions(spark, sf), "CartRule"))


def _prepared(spark, sf):
    return _shared(spark, sf, "prepared", lambda: M.Prepared(
        _model_ready(spark, sf), partitions=_train_partitions(spark)))


def _train_partitions(spark):
    """The session's ``sessionkit.trainPartitions``, or the input's own splits."""
    n = spark.conf.get("sessionkit.trainPartitions", None)
    return int(n) if n else None


def _notebook(spark, sf):
    """The notebook's enriched sessions, split three ways."""
    return _shared(spark, sf, "notebook", lambda: M.Prepared(
        S.enriched_sessions(_valid(spark, sf), by_month=False, partitions=_tasks(spark, sf)), features=PR.EDA_FEATURES,
        three_way=True, partitions=_train_partitions(spark)))


def _bakeoff_log(spark, sf):
    """Folder of the run log of one bake-off of the four default models."""
    def build():
        log = scratch_path(spark, "runlog")
        M.bakeoff(spark, _prepared(spark, sf), log)
        return log
    return _shared(spark, sf, "bakeoff", build)


def _champion(spark, sf):
    return _shared(spark, sf, "champion", lambda: M.fit_champion(_prepared(spark, sf)))


@register("resume_pending")
def q_resume_pending(spark, sf):
    data = _prepared(spark, sf)
    log = scratch_path(spark, "runlog")
    M.bakeoff(spark, data, log, models=["LogisticRegression"])
    return RP.pending_models(spark, M.DEFAULT_MODELS, log)


def _pred_out(pred):
    return pred.select("source_month", S.SESSION, S.LABEL,
                       F.col("prediction").cast("int").alias("prediction"))


@register("model_lr")
def q_model_lr(spark, sf):
    return _pred_out(M.fit_predict(_prepared(spark, sf), "LogisticRegression")[1])


@register("model_rf")
def q_model_rf(spark, sf):
    return _pred_out(M.fit_predict(_prepared(spark, sf), "RandomForest")[1])


@register("model_gbt")
def q_model_gbt(spark, sf):
    return _pred_out(M.fit_predict(_prepared(spark, sf), "XGBoost")[1])


@register("model_gbt_leafcapped")
def q_model_gbt_leafcapped(spark, sf):
    return _pred_out(M.fit_predict(_prepared(spark, sf), "LightGBM")[1])


@register("bakeoff")
def q_bakeoff(spark, sf):
    log = RP.read_run_log(spark, _bakeoff_log(spark, sf))
    top = M.top_models(log, 2)
    return log.withColumn("selected_for_tuning", F.col("model_name").isin(top))


@register("bakeoff_confusion")
def q_bakeoff_confusion(spark, sf):
    """L3b per logged model."""
    return RP.read_confusion(spark, _bakeoff_log(spark, sf))


@register("bakeoff_support")
def q_bakeoff_support(spark, sf):
    """The test rows per logged model and class: its confusion matrix's sums."""
    return RP.read_confusion(spark, _bakeoff_log(spark, sf)).groupBy("model_name", "actual").agg(
        F.sum("count").cast("bigint").alias("support"))


def _tuned_log(spark, sf):
    """Folder of the run log of one whole bake-off: the four default models, then
    the full grids of the two best of them (its ledger lies beside it)."""
    def build():
        log = scratch_path(spark, "runlog")
        M.bakeoff(spark, _prepared(spark, sf), log, tune_top=2)
        return log
    return _shared(spark, sf, "tuned", build)


@register("grid_search")
def q_grid_search(spark, sf):
    """Mean scores of every combination of the two best models' grids, from
    the search ledger."""
    return TU.mean_scores(TU.read_scores(spark, f"{_tuned_log(spark, sf)}_search"))


@register("random_search")
def q_random_search(spark, sf):
    res = TU.random_search(_notebook(spark, sf), "RandomForest", n_iter=10)
    return TU.scores_frame(spark, res)


@register("random_search_boosted")
def q_random_search_boosted(spark, sf):
    res = TU.random_search(_notebook(spark, sf), "XGBoost", n_iter=10)
    return TU.scores_frame(spark, res)


@register("fold_sizes")
def q_fold_sizes(spark, sf):
    """Rows per fold and class of the training part (the folds of L9 / L10)."""
    train, _ = _train_test(spark, sf)
    return PR.add_folds(train).groupBy("fold", S.LABEL).agg(F.count(F.lit(1)).alias("rows"))


@register("kmeans_nearest")
def q_kmeans_nearest(spark, sf):
    """Whether every row of a cluster of the k-means result has the same
    nearest fitted centre, no two clusters the same, and the number of rows."""
    m = materialize(_matrix(spark, sf))
    model, _ = SG.fit_kmeans(m)
    z = SG.zcols()
    labelled = SG.kmeans_segments(m, model)
    away = [sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x)))
                 for c, x in zip(z, center)), F.lit(0.0)) for center in model.clusterCenters()]
    nearest = F.array_position(F.array(*away), F.least(*away))
    pairs = labelled.groupBy(F.col(SG.CLUSTER_COL).alias("c"), nearest.alias("i")).count()
    n = F.count(F.lit(1))
    return pairs.agg(((n == F.count_distinct("c")) & (n == F.count_distinct("i"))).alias("nearest"),
                     F.sum("count").alias("rows"))


@register("importance_total")
def q_importance_total(spark, sf):
    """Number and sum of the champion's importances."""
    imp = M.feature_importance(_champion(spark, sf), _prepared(spark, sf).features, spark)
    return imp.agg(F.count(F.lit(1)).alias("features"),
                   F.round(F.sum("Importance"), 6).alias("total"))


@register("leaderboard")
def q_leaderboard(spark, sf):
    """The four default models and the two best ones tuned."""
    return RP.leaderboard(spark, _tuned_log(spark, sf))


@register("feature_importance")
def q_feature_importance(spark, sf):
    data = _prepared(spark, sf)
    return round_doubles(M.feature_importance(_champion(spark, sf), data.features, spark))


@register("champion_score")
def q_champion_score(spark, sf):
    data = _prepared(spark, sf)
    model = M.save_and_reload(_champion(spark, sf), scratch_path(spark, "champion"), spark)
    raw_test = data.test.drop("features", *data.scaled)
    return _pred_out(model.transform(raw_test))


# ----------------------------------------------------------------- sources and sinks


@register("csv_scan")
def q_csv_scan(spark, sf):
    """Events written as CSV, read back with the declared schema."""
    path = scratch_path(spark, "events-csv")
    IO.write_csv(_events(spark, sf), path)
    return _events_out(IO.read_events_csv(spark, path))


@register("csv_ingest_stream")
def q_csv_ingest_stream(spark, sf):
    """S1 + S4 incrementally: CSV drops -> partitioned Parquet via a file
    stream with an available-now trigger and a checkpoint."""
    src = scratch_path(spark, "events-csv-drop")
    IO.write_csv(_events(spark, sf), src)
    table = scratch_path(spark, "events-ingested")
    ingest_csv(spark, src, table, scratch_path(spark, "ingest-ckpt"))
    return _events_out(IO.read_parquet(spark, table).select(*EVENT_COLUMNS))


@register("csv_rejects")
def q_csv_rejects(spark, sf):
    """The events as CSV with the price of every purchase spoilt; the stream
    writes the other rows to the table and these, with the reason, aside."""
    src, table, rejects = (scratch_path(spark, x) for x in ("csv-spoilt", "csv-kept", "csv-rejects"))
    events = _events(spark, sf)
    price = F.when(F.col("event_type") == "purchase", F.concat(F.col("price").cast("string"), F.lit("?"))) \
        .otherwise(F.col("price").cast("string"))
    IO.write_csv(events.withColumn("price", price), src)
    ingest_csv(spark, src, table, scratch_path(spark, "rejects-ckpt"), rejects_dir=rejects)
    counts = reject_counts(spark, table, rejects)
    return counts.groupBy("reason").agg(F.sum("rows").alias("rows"))


@register("parquet_scan")
def q_parquet_scan(spark, sf):
    """S3: one monthly file of a month-partitioned table (partition pruning)."""
    path = scratch_path(spark, "events-monthly")
    IO.write_parquet(_events(spark, sf), path, ["source_month"])
    return _events_out(IO.read_parquet(spark, path, months=["A"]).select(*EVENT_COLUMNS))


@register("parquet_roundtrip")
def q_parquet_roundtrip(spark, sf):
    """Snappy Parquet sink and scan of the whole event table."""
    path = scratch_path(spark, "events-parquet")
    IO.write_parquet(_events(spark, sf), path)
    return _events_out(IO.read_parquet(spark, path))


@register("csv_report_roundtrip")
def q_csv_report_roundtrip(spark, sf):
    """A small report (the event funnel) as one CSV file, read back."""
    path = scratch_path(spark, "funnel-csv")
    RP.write_csv_report(QUERIES["event_funnel"](spark, sf), path)
    return spark.read.schema("event_type string, count bigint").option("header", True).csv(path)


@register("narrow_types")
def q_narrow_types(spark, sf):
    """The event table with every numeric column narrowed."""
    narrowed, _ = IO.narrow_types(_events(spark, sf))
    return _events_out(narrowed)


@register("narrow_report")
def q_narrow_report(spark, sf):
    """Old -> new type per numeric column."""
    return IO.narrow_report(_events(spark, sf))


@register("low_cardinality")
def q_low_cardinality(spark, sf):
    """Distinct / rows per string column, below 0.5 -> category."""
    return round_doubles(IO.low_cardinality(_events(spark, sf)))


@register("notebook_models")
def q_notebook_models(spark, sf):
    """L8a-L8c (notebook form), 70/15/15 split: default LR / RF on the basic
    sessions (A1, 3 features), then default LR and the tuned RF / GBT on the
    enriched sessions (A4, the notebook's 8 features)."""
    data = _notebook(spark, sf)
    basic = M.Prepared(_basic(spark, sf), features=PR.BASIC_FEATURES, three_way=True,
                       partitions=_train_partitions(spark))
    return round_doubles(M.notebook_models(spark, data, basic))
