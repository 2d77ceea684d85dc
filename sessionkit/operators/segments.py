"""Segmentation path.

Session features are computed per row; the statistics that scaling and
imputation need (medians, quartiles) come from the exact distributed
selection in ``functions.quantiles`` and are inlined as literals.  Cluster
tables have one row per cluster (k rows, bounded by the parameter), so every
operator after the assignment works on a k-row table; the only join back to
the sessions is a broadcast of that k-row table.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import (ZERO_SCALE, finite_or_null, fmt_int_half_even, per_minute, ratio_plus_one,
                               seconds_between)
from ..functions.quantiles import quantiles

# The 12 clustering features and the 4 log-transformed ones.
CLUSTER_FEATURES = [
    "duration_seconds", "total_events", "view_count", "cart_count",
    "unique_products", "unique_brands", "unique_categories",
    "avg_price", "events_per_minute", "cart_to_view_ratio",
    "products_per_event", "is_abandoned",
]
LOG_FEATURES = ["duration_seconds", "total_events", "view_count", "avg_price"]
CLUSTER_COL = "behavior_cluster"
N_CLUSTERS = 8

# Naming axes (label when above the 66% threshold, above the
# 33% threshold, otherwise) and the description templates.
RISK_NAMES = ("High-Risk", "Medium-Risk", "Low-Risk")
RISK_TEXT = ("very high abandonment", "moderate abandonment", "low abandonment")
DURATION_NAMES = ("Patient", "Balanced", "Quick")
DURATION_TEXT = ("long sessions", "medium sessions", "short sessions")
PRODUCT_NAMES = ("Explorer", "Browser", "Shopper")
PRICE_NAMES = ("Premium", "Mid-Range", "Budget")
PRICE_TEXT = ("premium price", "mid-range", "low price")
NAME_SEP = " | "
DESC_SEP = ", "
THRESHOLD_PROBS = (0.33, 0.66)
NAMED_METRICS = ["abandonment_rate", "avg_duration", "avg_products", "avg_price"]


def np_round(c, digits: int) -> Column:
    """numpy / pandas ``round``: ``rint(x * 10**d) / 10**d`` (half-even on the
    binary value; Spark's ``bround`` rounds the decimal text instead)."""
    scale = float(10 ** digits)
    x = F.col(c) if isinstance(c, str) else c
    return F.rint(x * F.lit(scale)) / F.lit(scale)


# --------------------------------------------------------------------------- E1-E5
def segment_features(sessions: DataFrame) -> DataFrame:
    """Duration and the engagement ratios."""
    return (sessions
            .withColumn("duration_seconds", seconds_between("session_start", "session_end"))
            .withColumn("events_per_minute", per_minute("total_events", "duration_seconds"))
            .withColumn("cart_to_view_ratio", ratio_plus_one("cart_count", "view_count"))
            .withColumn("purchase_to_cart_ratio", ratio_plus_one("purchase_count", "cart_count"))
            .withColumn("products_per_event", ratio_plus_one("unique_products", "total_events")))


# --------------------------------------------------------------------------- K1
def fit_median_imputer(df: DataFrame, cols: list[str], exact: bool = True) -> dict[str, float]:
    """K1 fit: median of each column after +-inf -> null (exact by default,
    ``exact=False`` for the one-pass sketch)."""
    clean = df.select([finite_or_null(c).alias(c) for c in cols])
    # Only columns with a missing or non-finite value need their median.
    row = clean.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in cols]).first()
    need = [c for c in cols if row[c] < row["__n"]]
    q = quantiles(clean, need, [0.5], exact=exact) if need else {}
    return {c: (q[c][0] if c in q else None) for c in cols}


def apply_median_imputer(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({
        c: (F.coalesce(finite_or_null(c), F.lit(m)) if m is not None else finite_or_null(c))
        for c, m in medians.items()})


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_median_imputer(df, fit_median_imputer(df, cols))


# --------------------------------------------------------------------------- E6
def log_features(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.log1p(F.col(c)) for c in (cols or LOG_FEATURES)})


# --------------------------------------------------------------------------- K2
def fit_robust_scaler(df: DataFrame, cols: list[str],
                      exact: bool = True) -> dict[str, tuple[float, float]]:
    """K2 fit: centre = median, scale = Q3 - Q1 (1 where that is 0 or of
    rounding size, so a constant or sparse column is left unscaled)."""
    q = quantiles(df.select(*cols), cols, [0.25, 0.5, 0.75], exact=exact)
    out = {}
    for c in cols:
        q1, med, q3 = q[c]
        iqr = (q3 - q1) if q1 is not None else None
        out[c] = (med if med is not None else 0.0,
                  iqr if iqr is not None and iqr >= ZERO_SCALE else 1.0)
    return out


def apply_robust_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                           for c, (m, s) in params.items()})


def robust_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_robust_scaler(df, fit_robust_scaler(df, cols))


def zcols(cols: list[str] | None = None, prefix: str = "z_") -> list[str]:
    return [prefix + c for c in (cols or CLUSTER_FEATURES)]


def cluster_matrix(features: DataFrame, cols: list[str] | None = None,
                   prefix: str = "z_") -> DataFrame:
    """The reference's ``X_scaled``: impute medians -> log1p -> robust scale.

    The scaled copies are added as ``z_<feature>`` columns next to the raw
    features, so the statistics after clustering need no join back.
    """
    cols = cols or CLUSTER_FEATURES
    z = zcols(cols, prefix)
    x = features.withColumns({prefix + c: F.col(c).cast("double") for c in cols})
    x = impute_median(x, z)
    x = log_features(x, [prefix + c for c in LOG_FEATURES if c in cols])
    return robust_scale(x, z)


# --------------------------------------------------------------------------- K4
def assign_nearest(df: DataFrame, centers: list[list[float]], cols: list[str],
                   out: str = CLUSTER_COL) -> DataFrame:
    """K4: index of the nearest centre (squared Euclidean), ties to the lower
    index.  Centres are k literals (bounded by k), so this is one projection."""
    dists = []
    for ctr in centers:
        terms = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
                 for c, v in zip(cols, ctr)]
        d = terms[0]
        for t in terms[1:]:
            d = d + t
        dists.append(d)
    best = F.least(*dists) if len(dists) > 1 else dists[0]
    expr = None
    for j in reversed(range(len(dists))):
        expr = F.when(dists[j] == best, F.lit(j)) if expr is None else \
            F.when(dists[j] == best, F.lit(j)).otherwise(expr)
    return df.withColumn(out, expr.cast("int"))


def seed_centers(matrix: DataFrame, k: int, cols: list[str], key: str = "user_session",
                 salt: str = "seg42") -> list[list[float]]:
    """Deterministic Forgy seeding: the ``k`` rows with the smallest salted
    md5 of the key (a per-task top-k; only k rows reach the driver)."""
    rows = (matrix.select(F.md5(F.concat(F.lit(salt + ":"), F.col(key))).alias("_h"), *cols)
            .orderBy("_h").limit(k).collect())
    return [[r[c] for c in cols] for r in rows]


# --------------------------------------------------------------------------- K3
def fit_kmeans(matrix: DataFrame, cols: list[str] | None = None, k: int = N_CLUSTERS,
               seed: int = 42, n_init: int = 10, max_iter: int = 100,
               tol: float | None = None):
    """K3: MLlib k-means (k-means|| init), best of ``n_init`` seeds by cost.

    The assembled vectors are cut from their lineage (a reliable checkpoint
    in the shared checkpoint folder, so a lost executor does not replay the
    session roll-up).  Each of the ``n_init`` runs caches them as MLlib does when
    the input is not cached: a cached table would be decoded in every step.
    ``tol`` defaults to scikit-learn's rule, 1e-4 x the mean feature variance.
    Returns (model, per-run seconds).
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler
    from ..session import ensure_checkpoint_dir

    cols = cols or zcols()
    ensure_checkpoint_dir(matrix.sparkSession)
    vec = (VectorAssembler(inputCols=cols, outputCol="features").transform(matrix)
           .select("features").checkpoint(eager=True))
    if tol is None:
        var = matrix.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
        vals = [var[c] or 0.0 for c in cols]
        tol = 1e-4 * (sum(vals) / len(vals)) if vals else 1e-4
    best, best_cost, times = None, None, []
    for s in range(seed, seed + n_init):
        t0 = time.time()
        model = KMeans(k=k, maxIter=max_iter, seed=s, tol=max(tol, 1e-12),
                       featuresCol="features").fit(vec)
        cost = model.summary.trainingCost
        times.append(time.time() - t0)
        if best_cost is None or cost < best_cost:
            best, best_cost = model, cost
    return best, times


def kmeans_segments(matrix: DataFrame, model, cols: list[str] | None = None) -> DataFrame:
    """K3 predict + stable relabelling: clusters renumbered by size (largest
    first, ties by the model's index).  Only the k cluster sizes reach the
    driver; the relabel is a k-entry map literal."""
    from pyspark.ml.feature import VectorAssembler
    cols = cols or zcols()
    pred = (model.transform(VectorAssembler(inputCols=cols, outputCol="features")
                            .transform(matrix))
            .withColumn("_raw", F.col("prediction").cast("int"))
            .drop("features", "prediction"))
    sizes = pred.groupBy("_raw").count().collect()  # k rows
    order = sorted(sizes, key=lambda r: (-r["count"], r["_raw"]))
    mapping = F.create_map(*[x for i, r in enumerate(order) for x in (F.lit(r["_raw"]), F.lit(i))])
    return pred.withColumn(CLUSTER_COL, mapping[F.col("_raw")]).drop("_raw")


# --------------------------------------------------------------------------- A9-A11
def _cluster_aggs() -> list[Column]:
    return [
        F.avg("duration_seconds").alias("avg_duration"),
        F.stddev_samp("duration_seconds").alias("std_duration"),
        F.avg("total_events").alias("avg_events"),
        F.avg("view_count").alias("avg_views"),
        F.avg("cart_count").alias("avg_carts"),
        F.avg("purchase_count").alias("avg_purchases"),
        F.avg("unique_products").alias("avg_products"),
        F.avg("avg_price").alias("avg_price"),
        F.avg("is_abandoned").alias("abandonment_rate"),
        F.count("user_session").alias("session_count"),
    ]


ANALYSIS_DOUBLES = ["avg_duration", "std_duration", "avg_events", "avg_views", "avg_carts",
                    "avg_purchases", "avg_products", "avg_price", "abandonment_rate"]


def cluster_analysis(clustered: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """A9 + A10: per-cluster stats rounded to 2 places (numpy rounding) and
    the share of all sessions, 1 place.  The share's total is a window over
    the k-row result, not over sessions."""
    g = clustered.groupBy(cluster_col).agg(*_cluster_aggs())
    g = g.withColumns({c: np_round(c, 2) for c in ANALYSIS_DOUBLES})
    total = F.sum("session_count").over(Window.partitionBy())
    return g.withColumn("percent_of_total",
                        np_round(F.col("session_count") / total * F.lit(100.0), 1))


def window_quantile(c: str, p: float) -> Column:
    """Linear-interpolation quantile of column ``c`` over the whole (k-row)
    table as a window expression: numpy's ``lerp`` on the sorted values, so
    a tie gives exactly the tied value (Spark's ``percentile`` blends the two
    neighbours with weights that need not sum to exactly 1)."""
    arr = F.sort_array(F.collect_list(F.col(c)).over(Window.partitionBy()))
    h = (F.size(arr) - 1).cast("double") * F.lit(float(p))
    lo, hi = F.floor(h).cast("int"), F.ceil(h).cast("int")
    a, b = F.element_at(arr, lo + 1), F.element_at(arr, hi + 1)
    t = h - lo.cast("double")
    return F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (F.lit(1.0) - t))


def with_thresholds(analysis: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Add ``<metric>_q33`` / ``<metric>_q66`` columns (33% / 66%
    quantiles of the rounded cluster metrics) to the k-row analysis table."""
    metrics = metrics or NAMED_METRICS
    lo_p, hi_p = THRESHOLD_PROBS
    return analysis.withColumns({
        **{f"{m}_q33": window_quantile(m, lo_p) for m in metrics},
        **{f"{m}_q66": window_quantile(m, hi_p) for m in metrics}})


def cluster_thresholds(analysis: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """A12 as a table: metric, q33, q66 (one row per named metric)."""
    metrics = metrics or NAMED_METRICS
    th = with_thresholds(analysis, metrics).limit(1)
    pairs = ", ".join(f"'{m}', `{m}_q33`, `{m}_q66`" for m in metrics)
    return th.selectExpr(f"stack({len(metrics)}, {pairs}) AS (metric, q33, q66)")


def thresholds_frame(analysis: DataFrame) -> DataFrame:
    return cluster_thresholds(analysis)


def _level(x: Column, m: str, labels: tuple) -> Column:
    return (F.when(x > F.col(f"{m}_q66"), F.lit(labels[0]))
            .when(x > F.col(f"{m}_q33"), F.lit(labels[1])).otherwise(F.lit(labels[2])))


def cluster_names(analysis: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """K5: rule-based name and description per cluster (strict ``>`` on the
    A12 thresholds; numbers formatted like Python's ``:.1%`` / ``:.0f``).
    One lazy plan over the k-row analysis table."""
    a = with_thresholds(analysis)
    rate, dur, prod, price = (F.col(c) for c in NAMED_METRICS)
    name = F.concat_ws(NAME_SEP,
                       _level(rate, "abandonment_rate", RISK_NAMES),
                       _level(dur, "avg_duration", DURATION_NAMES),
                       _level(prod, "avg_products", PRODUCT_NAMES),
                       _level(price, "avg_price", PRICE_NAMES))
    pct = F.concat(F.format_string("%.1f", rate * F.lit(100.0)), F.lit("%"))
    desc = F.concat_ws(
        DESC_SEP,
        F.concat(_level(rate, "abandonment_rate", RISK_TEXT), F.lit(" ("), pct, F.lit(")")),
        F.concat(_level(dur, "avg_duration", DURATION_TEXT), F.lit(" ("),
                 fmt_int_half_even(dur), F.lit("s)")),
        F.concat(F.lit("views "), fmt_int_half_even(prod), F.lit(" products")),
        F.concat(_level(price, "avg_price", PRICE_TEXT), F.lit(" ($"),
                 fmt_int_half_even(price), F.lit(")")))
    return a.select(F.col(cluster_col).alias("cluster_id"),
                    name.alias("cluster_name"), desc.alias("cluster_description"))


def named_sessions(clustered: DataFrame, names: DataFrame,
                   cluster_col: str = CLUSTER_COL) -> DataFrame:
    """Attach name and description; ``names`` has k rows -> broadcast."""
    nm = names.withColumnRenamed("cluster_id", cluster_col)
    return clustered.join(F.broadcast(nm), cluster_col, "left")


def cluster_summary(named: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """Unrounded stats with the cluster's name and description (the
    saved CSV report)."""
    return named.groupBy(cluster_col).agg(
        *[a for a in _cluster_aggs()],
        F.max("cluster_name").alias("cluster_name"),
        F.max("cluster_description").alias("cluster_description"))


# --------------------------------------------------------------------------- O3, C3-C5
def cluster_risk(analysis: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """Clusters by abandonment rate, flagged above the mean rate."""
    mean = F.avg("abandonment_rate").over(Window.partitionBy())
    return (analysis.select(cluster_col, "abandonment_rate",
                            (F.col("abandonment_rate") > mean).alias("above_mean"))
            .orderBy(F.desc("abandonment_rate"), cluster_col))


def cluster_bubbles(analysis: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """Bubble tables; size = count / max(count) x 1000."""
    size = F.col("session_count") / F.max("session_count").over(Window.partitionBy()) * 1000.0
    return analysis.select(cluster_col, "avg_duration", "avg_products", "avg_price",
                           "abandonment_rate", size.alias("bubble_size"))


def cluster_intensity(analysis: DataFrame, cluster_col: str = CLUSTER_COL) -> DataFrame:
    """C4: views / carts / purchases per cluster, long form."""
    return analysis.select(cluster_col, "avg_views", "avg_carts", "avg_purchases").unpivot(
        [cluster_col], ["avg_views", "avg_carts", "avg_purchases"], "measure", "value")


def cluster_cards(analysis: DataFrame, names: DataFrame,
                  cluster_col: str = CLUSTER_COL) -> DataFrame:
    """Card text per cluster: name, share, description cut to 40
    characters + "..."."""
    nm = names.withColumnRenamed("cluster_id", cluster_col)
    j = analysis.select(cluster_col, "percent_of_total").join(nm, cluster_col)
    return j.select(cluster_col, "cluster_name", "percent_of_total",
                    F.concat(F.substring("cluster_description", 1, 40), F.lit("..."))
                    .alias("card_text"))
