import math

import numpy as np
import pandas as pd

from sessionkit.operators import profile as P


def _prices(spark, n=500):
    rng = np.random.default_rng(11)
    x = np.round(rng.gamma(2.0, 30.0, n), 2)
    return x, spark.createDataFrame([(float(v), "view" if i % 3 else "cart") for i, v in enumerate(x)],
                                    "price double, event_type string")


def test_describe_matches_pandas(spark):
    x, df = _prices(spark)
    got = {r.statistic: r.value for r in P.describe(df, ["price"]).collect()}
    want = pd.Series(x).describe()
    for k in P.DESCRIBE_STATS:
        assert abs(got[k] - want[k]) < 1e-9 * max(1.0, abs(want[k])), k


def test_histogram_matches_numpy(spark):
    x, df = _prices(spark)
    got = sorted((r.bin, r["count"]) for r in P.histogram(df, "price", 50).collect())
    counts, _ = np.histogram(x, bins=50)
    assert [c for _, c in got] == counts.tolist()


def test_kde_matches_direct_sum(spark):
    x, df = _prices(spark, 200)
    rows = sorted(P.kde(df, "price", 20).collect(), key=lambda r: r.point)
    h = x.std(ddof=1) * len(x) ** (-0.2)
    for r in rows:
        want = np.exp(-0.5 * ((r.x - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
        assert abs(r.density - want) < 1e-12


def test_value_share_and_top_values(spark):
    _, df = _prices(spark, 300)
    share = {r.event_type: r.percent for r in P.value_share(df, "event_type").collect()}
    assert abs(sum(share.values()) - 100.0) < 1e-9 and abs(share["cart"] - 100 / 3) < 1e-9
    top = P.top_values(df, "event_type", 1).collect()
    assert top[0].event_type == "view" and top[0]["count"] == 200


def test_null_profile_and_shape(spark, fixture_events):
    prof = {r.column_name: r.non_null_count for r in P.null_profile(fixture_events).collect()}
    assert prof["user_session"] == 23 and prof["brand"] == 22
    assert P.shape(fixture_events).first()["rows"] == 24


def test_kde_by_moments_within_its_error_bound(spark):
    """Many cells, hot values and a far outlier; the bound is per row, of the kernel's peak."""
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.lognormal(3, 1, 3000), np.full(1000, 12.5), [5000.0, 0.01]])
    got = sorted(P.kde(spark.createDataFrame([(float(x),) for x in v], "price double"), "price").collect(),
                 key=lambda r: r.point)
    h = v.std(ddof=1) * len(v) ** -0.2
    x = np.linspace(v.min(), v.max(), 200)
    peak = 1 / (h * np.sqrt(2 * np.pi))
    want = np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).mean(axis=1) * peak
    assert [r.point for r in got] == list(range(200))
    np.testing.assert_allclose([r.x for r in got], x, rtol=1e-12)
    assert np.abs(np.array([r.density for r in got]) - want).max() <= 4e-12 * peak
    assert P.kde(spark.createDataFrame([(None,), (float("nan"),)], "price double"), "price").count() == 0
