"""Model preparation (L1, L2, L7, L13): stratified splits and folds, standard
scaling fitted on the training rows only, class weights.

Splits are deterministic without a sort or a single-partition window: each
row gets a salted md5 hash of its key, and per class the training rows are
those at or below the class's exact discrete quantile of the hash
(``percentile_disc``), found by the distributed selection in
``functions.quantiles``.  Each class therefore gets ceil(p * n_c) training
rows -- scikit-learn's stratified sizes to +-1 -- and the same key always
lands in the same split.
"""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import ZERO_SCALE
from ..functions.quantiles import exact_quantiles

SEED = 42
# The 8 model features of the bake-off (no max_price).
MODEL_FEATURES = [
    "duration_seconds", "products_viewed", "avg_price",
    "brands_viewed", "categories_viewed", "num_carts", "num_views",
    "is_returning_user",
]
# The notebook's 8 enriched features.
EDA_FEATURES = [
    "products_viewed", "avg_price", "max_price", "brands_viewed",
    "categories_viewed", "num_views", "num_carts", "duration_seconds",
]
# The notebook's basic session features.
BASIC_FEATURES = ["event_count", "products_viewed", "duration_seconds"]
LABEL = "is_abandoned"
KEYS = ["source_month", "user_session"]


def key_hash(keys: list[str], salt: str) -> Column:
    """32-bit unsigned hash of ``salt:key1:key2...`` from md5 (engine-neutral:
    DuckDB computes the same value)."""
    text = F.concat_ws(":", F.lit(salt), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _strata(df: DataFrame, label: str) -> list:
    """The classes of the label (a column of few classes by its meaning)."""
    return [r[0] for r in df.select(label).distinct().collect()]


def stratified_assign(df: DataFrame, label: str, cum_probs: list[float], names: list[str],
                      keys: list[str] | None = None, salt: str = str(SEED),
                      out: str = "split") -> DataFrame:
    """Assign each row to ``names[i]`` where its hash falls in the i-th
    per-class quantile band (``len(names) == len(cum_probs) + 1``).

    The hash of each class is a separate column (null outside the class), so
    the thresholds of all classes come from the same batched selection passes.
    """
    keys = keys or [k for k in KEYS if k in df.columns]
    h = df.withColumn("_h", key_hash(keys, salt))
    strata = _strata(df, label)
    conds = [(F.col(label) == F.lit(c)) if c is not None else F.col(label).isNull()
             for c in strata]
    per_class = h.select(*[F.when(cond, F.col("_h")).alias(f"_h{i}")
                           for i, cond in enumerate(conds)])
    th = exact_quantiles(per_class, [f"_h{i}" for i in range(len(strata))], cum_probs,
                         discrete=True)
    cases = None
    for i, cond in enumerate(conds):
        band = F.lit(names[-1])
        for t, name in reversed(list(zip(th[f"_h{i}"], names[:-1]))):
            band = F.when(F.col("_h") <= F.lit(int(t)), F.lit(name)).otherwise(band)
        cases = F.when(cond, band) if cases is None else cases.when(cond, band)
    return h.withColumn(out, cases).drop("_h")


def split_70_30(df: DataFrame, label: str = LABEL, keys: list[str] | None = None,
                seed: int = SEED) -> DataFrame:
    """L1: stratified 70/30 train/test."""
    return stratified_assign(df, label, [0.7], ["train", "test"], keys, str(seed))


def split_70_15_15(df: DataFrame, label: str = LABEL, keys: list[str] | None = None,
                   seed: int = SEED) -> DataFrame:
    """L2: stratified 70/15/15 train/validation/test."""
    return stratified_assign(df, label, [0.7, 0.85], ["train", "val", "test"], keys, str(seed))


def add_folds(train: DataFrame, label: str = LABEL, n_folds: int = 3,
              keys: list[str] | None = None, seed: int = SEED) -> DataFrame:
    """Stratified k-fold column ``fold`` (0..k-1) from a second salted hash,
    for ``CrossValidator(foldCol="fold")``."""
    probs = [i / n_folds for i in range(1, n_folds)]
    out = stratified_assign(train, label, probs, [str(i) for i in range(n_folds)], keys,
                            f"fold{seed}", out="fold")
    return out.withColumn("fold", F.col("fold").cast("int"))


# --------------------------------------------------------------------------- L7
def fit_standard_scaler(train: DataFrame, cols: list[str], suffix: str = "_z") -> SQLTransformer:
    """(x - mean) / population std, fitted on the training rows only
    (one aggregate).  Zero or rounding-size std -> scale 1.  Returned as a ``SQLTransformer``
    so it is a persistable stage of the saved pipeline."""
    row = train.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                    *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    exprs = []
    for c in cols:
        m = row[f"m_{c}"] or 0.0
        s = row[f"s_{c}"]
        s = s if s is not None and s >= ZERO_SCALE else 1.0
        exprs.append(f"(CAST(`{c}` AS DOUBLE) - ({m!r})) / ({s!r}) AS `{c}{suffix}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__")


def scaled_names(cols: list[str], suffix: str = "_z") -> list[str]:
    return [c + suffix for c in cols]


# --------------------------------------------------------------------------- L13
def class_counts(df: DataFrame, label: str = LABEL) -> dict:
    """Rows per class (one small aggregate; bounded by the number of classes)."""
    return {r[label]: r["count"] for r in df.groupBy(label).count().collect()}


def class_weights(df: DataFrame | None, label: str = LABEL, mode: str = "balanced",
                  counts: dict | None = None) -> dict:
    """``balanced``: n / (k * n_c); ``unbalance``: the rarer of the two
    classes weighted by the ratio of their sizes, the other 1.  Reads only the per-class counts (pass
    ``counts`` to reuse them)."""
    counts = counts if counts is not None else class_counts(df, label)
    n, k = sum(counts.values()), len(counts)
    if mode == "balanced":
        return {c: n / (k * m) for c, m in counts.items()}
    if mode == "unbalance":
        pos, neg = counts.get(1, 0), counts.get(0, 0)
        if not pos or not neg:
            return {0: 1.0, 1: 1.0}
        return {0: max(pos / neg, 1.0), 1: max(neg / pos, 1.0)}
    raise ValueError(mode)


def with_weights(df: DataFrame, weights: dict | None, label: str = LABEL,
                 col: str = "weight") -> DataFrame:
    if not weights:
        return df.withColumn(col, F.lit(1.0))
    expr = None
    for c, w in weights.items():
        expr = (F.when(F.col(label) == F.lit(c), F.lit(float(w))) if expr is None
                else expr.when(F.col(label) == F.lit(c), F.lit(float(w))))
    return df.withColumn(col, expr.otherwise(F.lit(1.0)))
