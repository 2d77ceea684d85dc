from pyspark.sql import functions as F

from sessionkit.plans import prep as PR


def _labeled(spark, n=1000):
    rows = [("A", f"s{i}", 1 if i % 4 == 0 else 0, float(i % 17), float(i % 5)) for i in range(n)]
    return spark.createDataFrame(rows, "source_month string, user_session string, "
                                       "is_abandoned int, x double, y double")


def test_split_is_stratified_disjoint_and_deterministic(spark):
    df = _labeled(spark)
    s1 = {(r.user_session): r.split for r in PR.split_70_30(df).collect()}
    s2 = {(r.user_session): r.split for r in PR.split_70_30(df).collect()}
    assert s1 == s2
    counts = PR.split_70_30(df).groupBy("is_abandoned", "split").count().collect()
    c = {(r.is_abandoned, r.split): r["count"] for r in counts}
    assert c[(1, "train")] == 175 and c[(1, "test")] == 75      # ceil(0.7 * 250)
    assert c[(0, "train")] == 525 and c[(0, "test")] == 225


def test_three_way_split_and_folds(spark):
    df = _labeled(spark)
    c = {r.split: r["count"] for r in PR.split_70_15_15(df).groupBy("split").count().collect()}
    assert c["train"] == 700 and c["val"] + c["test"] == 300 and abs(c["val"] - c["test"]) <= 2
    folds = PR.add_folds(PR.split_70_30(df).filter("split = 'train'"))
    fc = {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()}
    assert set(fc) == {0, 1, 2} and max(fc.values()) - min(fc.values()) <= 2


def test_standard_scaler_train_moments(spark):
    df = _labeled(spark)
    out = PR.fit_standard_scaler(df, ["x", "y"]).transform(df)
    m = out.agg(F.avg("x_z").alias("m"), F.stddev_pop("x_z").alias("s")).first()
    assert abs(m.m) < 1e-9 and abs(m.s - 1) < 1e-9


def test_class_weights(spark):
    df = _labeled(spark)
    w = PR.class_weights(df, mode="balanced")
    assert abs(w[1] - 1000 / (2 * 250)) < 1e-12 and abs(w[0] - 1000 / (2 * 750)) < 1e-12
    assert PR.class_weights(df, mode="unbalance") == {0: 1.0, 1: 3.0}
