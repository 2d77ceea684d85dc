import numpy as np
import pytest

from sessionkit.operators import kmeans as KM
from sessionkit.operators import segments as SG


def points(n=600, seed=5):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 6, (5, 3))
    return centers[rng.integers(0, 5, n)] + rng.normal(0, 1, (n, 3))


def frame(spark, x, partitions=4):
    return spark.createDataFrame([(f"k{i}", *map(float, r)) for i, r in enumerate(x)],
                                 "user_session string, a double, b double, c double") \
        .repartition(partitions)


def plain_lloyd(x, centers, tol, max_steps):
    for step in range(1, max_steps + 1):
        near = ((x[:, None] - centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        new = np.array([x[near == j].mean(axis=0) if (near == j).any() else centers[j]
                        for j in range(len(centers))])
        moved = ((new - centers) ** 2).sum()
        centers = new
        if moved <= tol:
            break
    cost = ((x[:, None] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum()
    return centers, cost, step


def test_every_start_equals_plain_lloyd_from_its_seeds(spark):
    x = points()
    df = frame(spark, x)
    cols = ["a", "b", "c"]
    seeds = KM.seed_starts(KM.vectors(df, cols, "user_session"), 5, 4, 3)
    got = KM.fit_starts(df, cols, 5, n_starts=4)
    tol = 1e-4 * x.var(axis=0).mean()
    assert [s.cost for s in got] == sorted(s.cost for s in got)
    for g in got:
        centers, cost, steps = plain_lloyd(x, seeds[g.number].centers, tol, 300)
        assert g.steps == steps
        assert g.cost == pytest.approx(cost, rel=1e-9)
        np.testing.assert_allclose(g.centers, centers, rtol=1e-9, atol=1e-9)


def test_seeds_are_rows_and_do_not_depend_on_partitions(spark):
    x = points(200)
    cols = ["a", "b", "c"]
    a, b = (KM.seed_starts(KM.vectors(frame(spark, x, p), cols, "user_session"), 5, 3, 3) for p in (1, 7))
    for s, t in zip(a, b):
        np.testing.assert_array_equal(s.centers, t.centers)
        assert len(np.unique(s.centers, axis=0)) == 5
        assert all((x == c).all(axis=1).any() for c in s.centers)
    assert not np.array_equal(a[0].centers, a[1].centers)


def test_draw_follows_squared_distances(spark):
    """With the first centre given, far points are drawn in proportion to d^2."""
    x = np.array([[0.0, 0, 0]] + [[1.0, 0, 0]] + [[3.0, 0, 0]])
    vecs = KM.vectors(frame(spark, x, 1), ["a", "b", "c"], "user_session")
    drawn = KM._draw(vecs, [[[0.0, 0.0, 0.0]]] * 2000, 2000, 3, "test")
    share = sum(v[0] == 3.0 for v in drawn) / 2000
    assert all(v[0] > 0 for v in drawn) and abs(share - 0.9) < 0.03


def test_one_pass_per_step_for_all_starts(spark):
    """The number of jobs follows the longest start, not the number of starts."""
    x = points(300)
    cols, tracker = ["a", "b", "c"], spark.sparkContext.statusTracker()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"starts-{n}", "test")
        fitted = KM.fit_starts(frame(spark, x), cols, 4, n_starts=n, max_steps=3, rel_tol=-1.0)
        spark.sparkContext.setJobGroup("", "")
        assert all(s.steps == 3 for s in fitted)
        return len(tracker.getJobIdsForGroup(f"starts-{n}"))
    assert jobs(1) == jobs(6)


def test_best_is_not_worse_than_ten_fits(spark):
    x = points(500, seed=9)
    df, cols = frame(spark, x), ["a", "b", "c"]
    best = KM.fit_starts(df, cols, 5)[0]
    model, _ = SG.fit_kmeans(df, cols, k=5)
    assert best.cost <= model.summary.trainingCost * (1 + 1e-3)


def test_empty_missing_and_repeated_rows(spark):
    cols = ["a", "b", "c"]
    assert KM.fit_starts(frame(spark, points(10)).limit(0), cols, 3) == []
    rows = [("k1", 1.0, 1.0, 1.0), ("k2", 1.0, 1.0, 1.0), ("k3", 5.0, 5.0, 5.0),
            ("k4", None, 1.0, 1.0), (None, float("nan"), 0.0, 0.0), ("k1", 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "user_session string, a double, b double, c double")
    best = KM.fit_starts(df, cols, 3, n_starts=2)[0]  # two distinct vectors, three clusters
    assert best.cost == 0.0 and len(np.unique(best.centers, axis=0)) == 2


def test_mllib_runs_get_vectors_that_no_step_decodes(spark, monkeypatch):
    """MLlib caches the vectors itself only if its input is not cached."""
    from pyspark.ml.clustering import KMeans
    levels, real = [], KMeans.fit
    monkeypatch.setattr(KMeans, "fit", lambda self, df: levels.append(
        df.storageLevel.useMemory or df.storageLevel.useDisk) or real(self, df))
    df = spark.createDataFrame([(float(i % 7), float(i % 3)) for i in range(60)], "a double, b double")
    model, times = SG.fit_kmeans(df, ["a", "b"], k=3, n_init=2)
    assert len(times) == 2 and len(model.clusterCenters()) == 3 and levels == [False, False]
