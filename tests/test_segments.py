import math

import numpy as np

from sessionkit.functions.quantiles import exact_quantiles
from sessionkit.operators import segments as SG


def test_robust_scaler_fixture(spark):
    """Columns 0..9 and (0 x 9, 1): median 4.5 / IQR 4.5; IQR 0 stays unscaled."""
    df = spark.createDataFrame([(float(i), 1.0 if i == 9 else 0.0) for i in range(10)], "a double, b double")
    params = SG.fit_robust_scaler(df, ["a", "b"])
    assert params["a"] == (4.5, 4.5)
    assert params["b"] == (0.0, 1.0)
    out = SG.apply_robust_scaler(df, params).collect()
    assert [r.b for r in out if r.b != 0.0] == [1.0]


def test_quantile_fixture(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    q = exact_quantiles(df, ["x"], [0.33, 0.66, 0.5])["x"]
    assert [round(v, 2) for v in q] == [1.99, 3.96, 3.0]


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.lognormal(3, 1, 20000), 2)
    df = spark.createDataFrame([(float(v),) for v in x], "x double").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.33, 0.5, 0.66, 0.75, 0.9, 1.0]
    got = exact_quantiles(df, ["x"], probs)["x"]
    assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)
    disc = exact_quantiles(df, ["x"], [0.7, 0.3], discrete=True)["x"]
    s = np.sort(x)
    assert disc == [s[math.ceil(p * len(s)) - 1] for p in (0.7, 0.3)]


def test_median_imputation_ignores_inf(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (None,), (10.0,)], "x double")
    out = [r.x for r in SG.impute_median(df, ["x"]).collect()]
    assert sorted(out) == [1.0, 2.0, 2.0, 2.0, 10.0]


def test_assign_nearest_is_argmin(spark):
    rng = np.random.default_rng(3)
    pts = rng.normal(size=(200, 3))
    ctr = rng.normal(size=(5, 3)).tolist()
    df = spark.createDataFrame([tuple(map(float, p)) + (i,) for i, p in enumerate(pts)],
                               "a double, b double, c double, i int")
    got = {r.i: r.behavior_cluster for r in SG.assign_nearest(df, ctr, ["a", "b", "c"]).collect()}
    want = np.argmin(((pts[:, None, :] - np.array(ctr)[None]) ** 2).sum(-1), axis=1)
    assert all(got[i] == want[i] for i in range(len(pts)))


# Published per-cluster stats, rounded to 2 places as the naming step sees
# them (abandonment_rate, avg_duration, avg_products, avg_price).
PUBLISHED = [
    (0, 0.15, 1483.58, 1.77, 323.55), (1, 0.50, 1.10, 1.04, 310.96),
    (2, 0.10, 2676.38, 12.95, 249.17), (3, 0.05, 2441.52, 5.09, 302.10),
    (4, 0.29, 4.02, 1.09, 331.43), (5, 0.14, 4244.54, 33.93, 226.31),
    (6, 0.11, 19.69, 1.61, 335.81), (7, 0.00, 163.06, 1.21, 318.34),
]
PUBLISHED_NAMES = {
    0: ("High-Risk | Balanced | Browser | Premium",
        "very high abandonment (15.0%), medium sessions (1484s), views 2 products, premium price ($324)"),
    1: ("High-Risk | Quick | Shopper | Mid-Range",
        "very high abandonment (50.0%), short sessions (1s), views 1 products, mid-range ($311)"),
    2: ("Low-Risk | Patient | Explorer | Budget",
        "low abandonment (10.0%), long sessions (2676s), views 13 products, low price ($249)"),
    3: ("Low-Risk | Patient | Explorer | Budget",
        "low abandonment (5.0%), long sessions (2442s), views 5 products, low price ($302)"),
    4: ("High-Risk | Quick | Shopper | Premium",
        "very high abandonment (29.0%), short sessions (4s), views 1 products, premium price ($331)"),
    5: ("Medium-Risk | Patient | Explorer | Budget",
        "moderate abandonment (14.0%), long sessions (4245s), views 34 products, low price ($226)"),
    6: ("Medium-Risk | Quick | Browser | Premium",
        "moderate abandonment (11.0%), short sessions (20s), views 2 products, premium price ($336)"),
    7: ("Low-Risk | Balanced | Shopper | Mid-Range",
        "low abandonment (0.0%), medium sessions (163s), views 1 products, mid-range ($318)"),
}


def test_cluster_names_reproduce_published_mapping(spark):
    an = spark.createDataFrame(PUBLISHED, "behavior_cluster int, abandonment_rate double, "
                                          "avg_duration double, avg_products double, avg_price double")
    got = {r.cluster_id: (r.cluster_name, r.cluster_description)
           for r in SG.cluster_names(an).collect()}
    assert got == PUBLISHED_NAMES


def test_np_round_is_half_even_on_binary(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (1.005,), (0.285,)], "x double")
    got = [r.y for r in df.select(SG.np_round("x", 2).alias("y")).collect()]
    assert got == [float(np.round(v, 2)) for v in (2.675, 0.125, 1.005, 0.285)]


def test_cluster_analysis_shares(spark):
    rows = [(f"s{i}", i % 2, float(i), i, i, i % 3, 0, i, float(i), i % 2) for i in range(10)]
    df = spark.createDataFrame(rows, "user_session string, behavior_cluster int, duration_seconds double, "
                                     "total_events long, view_count long, cart_count long, "
                                     "purchase_count long, unique_products long, avg_price double, "
                                     "is_abandoned int")
    an = {r.behavior_cluster: r for r in SG.cluster_analysis(df).collect()}
    assert an[0].session_count == 5 and an[0].percent_of_total == 50.0
    assert an[1].abandonment_rate == 1.0
    assert an[0].avg_duration == 4.0


def test_approx_quantiles_close(spark):
    from sessionkit.functions.quantiles import quantiles
    df = spark.createDataFrame([(float(i),) for i in range(1001)], "x double")
    ex = quantiles(df, ["x"], [0.25, 0.5], exact=True)["x"]
    ap = quantiles(df, ["x"], [0.25, 0.5], exact=False)["x"]
    assert ex == [250.0, 500.0] and all(abs(a - b) <= 1.0 for a, b in zip(ap, ex))
