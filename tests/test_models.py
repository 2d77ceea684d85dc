"""Model properties on the smallest driver tables, with short training runs."""

from sessionkit.operators import sessions as S
from sessionkit.plans import models as M
from sessionkit.plans import tuning as TU
from sessionkit.session import scratch_path
from sessionkit.sources.adapter import load_events

SF_SMALL = "/root/testdata/sf0.001"


def _data(spark):
    return M.Prepared(S.build_model_ready(load_events(spark, SF_SMALL)))


def test_models_predict_every_test_row_and_champion_reloads(spark):
    data = _data(spark)
    n_test = data.test.count()
    for name, params in (("LogisticRegression", None),
                         ("RandomForest", {"n_estimators": 10}),
                         ("LightGBM", {"n_estimators": 5})):
        _, pred, secs = M.fit_predict(data, name, params)
        assert pred.count() == n_test and secs > 0
    champ = M.fit_champion(data, {"n_estimators": 5, "max_depth": 3})
    imp = M.feature_importance(champ, data.features, spark).collect()
    assert len(imp) == 8 and abs(sum(r.Importance for r in imp) - 1.0) < 1e-9
    raw = data.test.drop("features", *data.scaled)
    again = M.save_and_reload(champ, scratch_path(spark, "t-champ"), spark)
    a = sorted((r.user_session, r.prediction) for r in champ.transform(raw).collect())
    b = sorted((r.user_session, r.prediction) for r in again.transform(raw).collect())
    assert a == b


def test_grid_search_and_random_draws(spark):
    data = _data(spark)
    res = TU.grid_search(data, "LogisticRegression", {"C": [0.1, 1.0], "class_weight": [None]})
    assert len(res.scores) == 2 and res.best_params in [c for c, _ in res.scores]
    draws = TU.sample_grid(TU.RANDOM_SPACES["RandomForest"], 10)
    assert len(draws) == 10 and len({repr(d) for d in draws}) == 10
    assert draws == TU.sample_grid(TU.RANDOM_SPACES["RandomForest"], 10)


def test_lr_reg_param_follows_c(spark):
    clf = M.make_classifier("LogisticRegression", {"C": 10}, n_weight=100.0)
    assert abs(clf.getRegParam() - 1 / 1000) < 1e-15


def test_bakeoff_resumes_from_log(spark, monkeypatch):
    data = _data(spark)
    log = scratch_path(spark, "t-bake")
    first = M.bakeoff(spark, data, log, models=["LogisticRegression"]).collect()
    assert [r.model_name for r in first] == ["LogisticRegression"]
    calls = []
    real = M.fit_predict
    monkeypatch.setattr(M, "fit_predict", lambda d, n, p=None: calls.append(n) or real(
        d, n, {"n_estimators": 5} if n != "LogisticRegression" else None))
    log_df = M.bakeoff(spark, data, log, models=["LogisticRegression", "RandomForest"])
    assert calls == ["RandomForest"]
    rows = {r.model_name: r for r in log_df.collect()}
    assert set(rows) == {"LogisticRegression", "RandomForest"}
    assert rows["LogisticRegression"].train_time_sec == first[0].train_time_sec
    assert all(0.0 <= rows[m].weighted_avg_f1 <= 1.0 for m in rows)


def test_logistic_regression_equals_newton(spark):
    """Coefficients against a Newton solution of C * sum(loss) + |w|^2 / 2."""
    import numpy as np
    data = _data(spark)
    model = M.make_classifier("LogisticRegression", {"C": 0.5}, float(data.n_train)).fit(data.train)
    rows = data.train.select(*data.scaled, data.label).toPandas().to_numpy(dtype=float)
    x, y = np.c_[rows[:, :-1], np.ones(len(rows))], rows[:, -1]
    w, keep = np.zeros(x.shape[1]), np.r_[np.ones(x.shape[1] - 1), 0.0] / 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(keep + 1e-12),
                                x.T @ (p - y) + keep * w)
    p = 1 / (1 + np.exp(-x @ w))
    ours = 1 / (1 + np.exp(-x @ np.r_[model.coefficients.toArray(), model.intercept]))
    objective = lambda v: (-np.log(np.where(y == 1, v, 1 - v)).sum())
    assert abs(objective(ours) - objective(p)) <= 0.01 * len(y) ** 0.5
    assert np.abs(ours - p).max() < 0.02


def test_folds_scale_the_penalty_and_equal_points_share_a_fit(spark, monkeypatch):
    data = _data(spark)
    seen = []
    real = M.make_classifier
    monkeypatch.setattr(M, "make_classifier", lambda name, params=None, n=1.0, **kw: (
        seen.append((name, n)), real(name, params, n, **kw))[1])
    TU.grid_search(data, "LogisticRegression", {"C": [1.0], "class_weight": [None]}, parallelism=1)
    fitted = [n for _, n in seen if n != 1.0]
    assert len(fitted) == 4 and fitted[-1] == data.n_train
    assert abs(sum(fitted[:3]) - 2 * data.n_train) < 1e-9
    grid = TU.expand_grid({"max_depth": [10, 30, None]})
    assert len({TU._meaning("RandomForest", c) for c in grid}) == 2


def test_depths_beyond_spark_are_refused():
    import pytest
    with pytest.raises(ValueError):
        M.depth_of(31)
    assert M.depth_of(None) == M.depth_of(30) == 30


def test_rarer_class_is_weighted():
    from sessionkit.plans import prep
    assert prep.class_weights(None, mode="unbalance", counts={0: 6, 1: 2}) == {0: 1.0, 1: 3.0}
    assert prep.class_weights(None, mode="unbalance", counts={0: 2, 1: 6}) == {0: 3.0, 1: 1.0}


def test_killed_search_resumes_and_equals_an_unbroken_one(spark, monkeypatch):
    """The driver is lost while the second batch of fits is on its way."""
    import pytest
    from sessionkit.plans import boosting
    data = _data(spark)
    space = {"n_estimators": [2, 4], "learning_rate": [0.1, 0.3], "max_depth": [2, 3],
             "subsample": [0.8], "colsample": [0.7]}
    combos = TU.expand_grid(space)
    whole = TU.boosted_scores(data, {"XGBoost": combos}, "accuracy", together=12)
    assert len(whole) == len(combos) * 3
    ledger, real, calls = scratch_path(spark, "t-ledger"), boosting.fit_many, []

    def dies(*a, **kw):
        calls.append(len(a[2]))
        if len(calls) >= 2:
            raise RuntimeError("lost")
        return real(*a, **kw)
    monkeypatch.setattr(boosting, "fit_many", dies)
    monkeypatch.setattr(boosting, "TASK_ROWS", 1)  # one batch after another
    with pytest.raises(RuntimeError):
        TU.boosted_scores(data, {"XGBoost": combos}, "accuracy", ledger=ledger, together=5)
    monkeypatch.undo()
    kept = TU.read_scores(spark, ledger).count()
    assert kept == 8 and len(TU.pending_scores(spark, ledger, "XGBoost", combos, "accuracy", 3)) == 16
    res = TU.search(data, "XGBoost", combos, "accuracy", ledger=ledger, refit=False)
    rows = TU.read_scores(spark, ledger).collect()
    assert {(r["model"], r["combo"], r["fold"]): r["score"] for r in rows} == whole
    assert len(rows) == len(whole) and len(res.scores) == len(combos)
    assert TU.mean_scores(TU.read_scores(spark, ledger)).filter("is_best").count() == 1


def test_forest_and_boosted_searches_run_and_score_like_single_fits(spark):
    data = _data(spark)
    from pyspark.sql import functions as F
    for name, space in (("RandomForest", {"n_estimators": [3], "max_depth": [2, None]}),
                        ("LightGBM", {"n_estimators": [3, 5], "num_leaves": [4], "is_unbalance": [True]})):
        res = TU.random_search(data, name, 2, space)
        assert len(res.scores) == 2 and res.test_predictions.count() == data.test.count()
    combo = res.scores[0][0]
    spec = M.boost_spec("LightGBM", combo, data.unbalance)
    from sessionkit.plans import boosting
    total = 0.0
    for fold in range(3):
        part = data.train.filter(F.col("fold") != fold)
        model = boosting.fit_many(part, data.scaled, [spec], data.label, data.keys,
                                  boosting.bin_edges(data.train, data.scaled))[0]
        out = model.transform(data.train.filter(F.col("fold") == fold))
        total += out.agg(F.avg((F.col("prediction") == F.col(data.label)).cast("int"))).first()[0] / 3
    assert abs(total - res.scores[0][1]) < 1e-12


def test_leaderboard_tunes_the_two_best(spark):
    data = _data(spark)
    log = scratch_path(spark, "t-six")
    grids = {"LogisticRegression": {"C": [1.0]}, "RandomForest": {"n_estimators": [2], "max_depth": [3]},
             "XGBoost": {"n_estimators": [2, 3], "max_depth": [2]},
             "LightGBM": {"n_estimators": [2, 3], "num_leaves": [4]}}
    rows = M.bakeoff(spark, data, log, tune_top=2, grids=grids).collect()
    plain = [r for r in rows if not r.is_tuned]
    best = sorted(plain, key=lambda r: (-r.weighted_avg_f1, M.DEFAULT_MODELS.index(r.model_name)))[:2]
    assert len(rows) == 6 and {r.model_name for r in rows if r.is_tuned} == {
        f"{r.model_name}_Tuned" for r in best}


def test_searches_of_few_rows_go_side_by_side_costly_fits_first(spark, monkeypatch):
    import threading

    from pyspark.sql import functions as F
    shallow, deep = (M.boost_spec("XGBoost", {"max_depth": d, "n_estimators": 10}) for d in (5, 15))
    assert TU._work(deep) > TU._work(shallow)
    data = _data(spark)
    both, met = threading.Barrier(2, timeout=120), []

    def search(data, name, grid, **kw):
        both.wait()  # breaks when the second search waits for the first
        met.append(name)
        return TU.SearchResult({}, [], 1.0, data.test.withColumn("prediction", F.lit(0.0)), None)
    monkeypatch.setattr(TU, "grid_search", search)
    monkeypatch.setattr(M, "fit_predict", lambda data, name: (
        None, data.test.withColumn("prediction", F.col(data.label).cast("double")), 1.0))
    monkeypatch.setattr(TU, "boosted_scores", lambda *a, **k: {})
    out = M.bakeoff(spark, data, scratch_path(spark, "t-side"), ["RandomForest", "XGBoost"], tune_top=2)
    assert sorted(met) == ["RandomForest", "XGBoost"]
    assert [r.model_name for r in out.filter("is_tuned").orderBy("model_name").collect()] \
        == ["RandomForest_Tuned", "XGBoost_Tuned"]


def test_a_search_on_a_million_rows_gives_each_task_a_whole_fit(spark, monkeypatch):
    from sessionkit.plans import boosting
    data, calls = _data(spark), []
    monkeypatch.setattr(data, "n_train", 1_000_000)
    monkeypatch.setattr(boosting, "fit_many", lambda *a, **kw: calls.append(len(a[2])))
    combos = TU.expand_grid({"n_estimators": [2, 4], "learning_rate": [0.1, 0.3], "max_depth": [2]})
    TU.boosted_scores(data, {"XGBoost": combos})
    assert calls == [1] * 6  # two models, three folds: none waits for a pass shared with others
