
from sessionkit.plans import models as M
from sessionkit.plans import report as RP
from sessionkit.session import scratch_path


def _pred(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 0), (0, 0), (0, 1)]
    return spark.createDataFrame(rows, "prediction int, is_abandoned int")


def test_report_fixture(spark):
    m = RP.metrics_frame(_pred(spark)).first()
    assert abs(m.accuracy - 4 / 6) < 1e-12
    assert m.abandoned_precision == m.abandoned_recall == m.abandoned_f1 == 0.5
    assert round(m.weighted_avg_f1, 4) == 0.6667
    rep = {r["class"]: r for r in RP.classification_report(_pred(spark)).collect()}
    assert rep["Abandoned (1)"].support == 2 and rep["accuracy"].support == 6


def test_confusion_matrix_sums_to_n(spark):
    cm = RP.confusion_matrix(_pred(spark)).collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == 6


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 1)], "prediction int, is_abandoned int")
    m = RP.metrics_frame(df).first()
    assert m.abandoned_precision == 0.0 and m.abandoned_f1 == 0.0


# The reference's run log in run order (model, tuned, weighted F1).
RUNS = [("LogisticRegression", False, 0.9357), ("RandomForest", False, 0.9659),
        ("XGBoost", False, 0.9695), ("LightGBM", False, 0.969),
        ("XGBoost_Tuned", True, 1.0 * 0.9697), ("LightGBM_Tuned", True, 0.9693)]


def _row(name, tuned, f1):
    r = {"model_name": name, "is_tuned": tuned, "train_time_sec": 1.0}
    r.update({k: 0.5 for k in RP.REPORT_METRICS})
    r["weighted_avg_f1"] = f1
    return r


def test_resume_and_leaderboard(spark):
    log = scratch_path(spark, "test-runlog")
    assert [r.model_name for r in RP.pending_models(spark, M.DEFAULT_MODELS, log).collect()] \
        == M.DEFAULT_MODELS
    for run in RUNS[:2]:
        RP.append_run(spark, log, _row(*run))
    pending = [r.model_name for r in RP.pending_models(spark, M.DEFAULT_MODELS, log).collect()]
    assert pending == ["XGBoost", "LightGBM"]
    for run in RUNS[2:]:
        RP.append_run(spark, log, _row(*run))
    board = [r.model_name for r in RP.leaderboard(spark, log).collect()]
    assert board == ["XGBoost_Tuned", "XGBoost", "LightGBM_Tuned", "LightGBM",
                     "RandomForest", "LogisticRegression"]
    assert M.top_models(RP.read_run_log(spark, log), 2) == ["XGBoost", "LightGBM"]


def test_metrics_long_melts_three_rows(spark):
    out = RP.metrics_long(_pred(spark), "m").collect()
    assert sorted(r.metric for r in out) == ["F1-Score", "Precision", "Recall"]
    assert all(r.score == 0.5 for r in out)
