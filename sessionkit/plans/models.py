"""Classifiers, the bake-off, the champion and its importances (L6, L8, L11,
L12, L14) on MLlib.

The reference's four estimators map to MLlib as follows (scores are not
comparable to the published ones; XGBoost and LightGBM are not Spark
libraries):

* LogisticRegression(C, max_iter=1000) -> ``LogisticRegression`` with
  ``regParam = 1 / (C * sum of weights)`` (scikit-learn minimises
  C * sum(loss) + |w|^2 / 2), no internal standardisation;
* RandomForest(n_estimators, max_depth, min_samples_leaf, max_features)
  -> ``forest.py`` (depth "None" -> 30, the maximum of MLlib's forest, whose
  counts per node and bin take the time of deep trees; a greater depth is refused);
* XGBoost (level-wise, 100 rounds, depth 6, rate 0.3, L2 1, least hessian 1)
  and LightGBM (leaf-wise, 100 rounds, 31 leaves, rate 0.1, 20 rows a leaf)
  -> ``boosting.py``: second-order boosting on gradient histograms.

Training data is cut from its lineage (checkpoint) and cached once; boosted
models checkpoint their margins, so a lost executor does not replay the history.
"""

from __future__ import annotations

import math
import time
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import boosting, forest, prep, report

SEED = 42
MAX_SPARK_DEPTH = 30
DEFAULT_MODELS = ["LogisticRegression", "RandomForest", "XGBoost", "LightGBM"]

# The library defaults the reference relies on.
DEFAULT_PARAMS = {
    "LogisticRegression": {"C": 1.0, "class_weight": None, "max_iter": 1000},
    "RandomForest": {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1,
                     "max_features": "sqrt", "class_weight": None},
    "XGBoost": {"n_estimators": 100, "learning_rate": 0.3, "max_depth": 6},
    "LightGBM": {"n_estimators": 100, "learning_rate": 0.1, "num_leaves": 31,
                 "min_child_samples": 20, "is_unbalance": False},
}
# The champion's parameters.
CHAMPION_PARAMS = {"n_estimators": 300, "learning_rate": 0.05, "max_depth": 10}
# The notebook's tuned models (min_samples_split=2 is the
# default split rule and has no MLlib parameter).
EDA_TUNED = {
    "RandomForest": {"n_estimators": 300, "max_depth": None, "min_samples_leaf": 4,
                     "max_features": "sqrt"},
    "XGBoost": {"n_estimators": 300, "max_depth": 5, "learning_rate": 0.2,
                "subsample": 0.8, "colsample": 0.9},
}

WEIGHT_COLS = {"balanced": "w_balanced", "unbalance": "w_unbalance"}


def depth_of(max_depth) -> int:
    if max_depth is not None and int(max_depth) > MAX_SPARK_DEPTH:
        raise ValueError(f"max_depth {max_depth} is above Spark's {MAX_SPARK_DEPTH}")
    return MAX_SPARK_DEPTH if max_depth is None else int(max_depth)


BOOSTED = ("XGBoost", "LightGBM", "Champion")


def boost_spec(name: str, params: dict | None = None, weights: tuple = (1.0, 1.0),
               fold: int | None = None) -> boosting.Spec:
    """The boosted model of a reference name and its parameters; ``weights`` are
    the class weights that an unbalanced model takes."""
    p = {**DEFAULT_PARAMS[name.replace("Champion", "XGBoost")], **(params or {})}
    common = {"rounds": int(p["n_estimators"]), "rate": float(p["learning_rate"]), "fold": fold,
              "row_share": float(p.get("subsample", 1.0)),
              "feature_share": float(p.get("colsample", 1.0))}
    if name == "LightGBM":
        return boosting.Spec(max_leaves=int(p["num_leaves"]), l2=0.0, least_hessian=1e-3,
                             least_rows=int(p["min_child_samples"]),
                             weights=tuple(weights) if p.get("is_unbalance") else (1.0, 1.0), **common)
    return boosting.Spec(max_depth=int(p["max_depth"]), **common)


def forest_spec(params: dict | None = None, weights: tuple = (1.0, 1.0), fold: int | None = None,
                n_features: int = len(prep.MODEL_FEATURES)) -> forest.Spec:
    """The forest of the reference's parameters; ``weights`` are the class weights
    that a balanced forest takes."""
    p = {**DEFAULT_PARAMS["RandomForest"], **(params or {})}
    tried = {"sqrt": math.sqrt, "log2": math.log2}[p["max_features"]](n_features)
    return forest.Spec(trees=int(p["n_estimators"]), max_depth=depth_of(p["max_depth"]),
                       least_rows=int(p["min_samples_leaf"]), tried=max(1, math.ceil(tried)),
                       weights=tuple(weights) if p["class_weight"] == "balanced" else (1.0, 1.0),
                       fold=fold, seed=SEED)


def make_classifier(name: str, params: dict | None = None, n_weight: float = 1.0,
                    features: str = "features", label: str = prep.LABEL):
    """One MLlib classifier for a reference model name and its parameters."""
    p = {**DEFAULT_PARAMS.get(name, {}), **(params or {})}
    common = {"featuresCol": features, "labelCol": label}
    if name == "LogisticRegression":
        wc = WEIGHT_COLS.get(p.get("class_weight"), "")
        return LogisticRegression(maxIter=int(p["max_iter"]), regParam=1.0 / (p["C"] * n_weight),
                                  elasticNetParam=0.0, standardization=False, tol=1e-4,
                                  family="binomial", weightCol=wc, **common)
    raise ValueError(f"unknown model {name}")


# --------------------------------------------------------------------------- data
class Prepared:
    """Model-ready sessions split 70/30, scaled on train, with class-weight
    and fold columns; both sides checkpointed and cached.

    Tree learners run one task per partition and pass, and row sampling
    follows the partitions: ``partitions`` sets their number (by the hash of
    the row's keys, so that it alone decides); unset, the input's splits stay.
    """

    def __init__(self, sessions: DataFrame, features: list[str] | None = None,
                 label: str = prep.LABEL, n_folds: int = 3, three_way: bool = False,
                 partitions: int | None = None):
        self.features = features or prep.MODEL_FEATURES
        self.label = label
        split = (prep.split_70_15_15(sessions, label) if three_way
                 else prep.split_70_30(sessions, label))
        split = materialize(split)
        train = split.filter(F.col("split") == "train")
        self.scaler = prep.fit_standard_scaler(train, self.features)
        self.scaled = prep.scaled_names(self.features)
        self.assembler = VectorAssembler(inputCols=self.scaled, outputCol="features")
        train = prep.add_folds(train, label, n_folds)
        counts = prep.class_counts(train, label)
        rare = prep.class_weights(None, label, "unbalance", counts)
        self.unbalance = (rare.get(0, 1.0), rare.get(1, 1.0))
        even = prep.class_weights(None, label, "balanced", counts)
        self.balanced = (even.get(0, 1.0), even.get(1, 1.0))
        self.keys = [k for k in prep.KEYS if k in sessions.columns]
        for mode, col in WEIGHT_COLS.items():
            train = prep.with_weights(train, prep.class_weights(None, label, mode, counts),
                                      label, col)
        train = self.assembler.transform(self.scaler.transform(train))
        if partitions:
            train = train.repartition(partitions, *[k for k in prep.KEYS if k in train.columns])
        self.train = train.persist()
        self.test = self.assembler.transform(
            self.scaler.transform(split.filter(F.col("split") == "test"))).persist()
        self.val = (self.assembler.transform(
            self.scaler.transform(split.filter(F.col("split") == "val"))).persist()
            if three_way else None)
        self.n_train = self.train.count()
        self._binned = None

    def binned(self) -> forest.Rows:
        """The training rows as blocks of bins, for forests; made once."""
        if self._binned is None:
            self._binned = forest.Rows(self.train, self.scaled, self.label, self.keys)
        return self._binned

    def unpersist(self):
        if self._binned is not None:
            self._binned.release()
        for df in (self.train, self.test, self.val):
            if df is not None:
                df.unpersist()


def fit_model(data: Prepared, name: str, params: dict | None = None):
    """One model on all training rows."""
    if name in BOOSTED:
        return boosting.fit(data.train, data.scaled, boost_spec(name, params, data.unbalance),
                            data.label, data.keys)
    if name == "RandomForest":
        return forest.fit(data.binned(), forest_spec(params, data.balanced, n_features=len(data.scaled)))
    return make_classifier(name, params, float(data.n_train), label=data.label).fit(data.train)


def fit_predict(data: Prepared, name: str, params: dict | None = None):
    """Fit on train, predict test, timed together (the reference's span).
    Returns (model, predictions, seconds)."""
    t0 = time.time()
    model = fit_model(data, name, params)
    pred = model.transform(data.test).persist()
    pred.count()
    return model, pred, time.time() - t0


# --------------------------------------------------------------------------- L6
def top_models(log: DataFrame, k: int = 2, order: list[str] | None = None) -> list[str]:
    """O2: best ``k`` untuned models by weighted F1; ties keep run order."""
    order = order or DEFAULT_MODELS
    rows = log.filter(~F.col("is_tuned")).select("model_name", "weighted_avg_f1").collect()
    rank = {n: i for i, n in enumerate(order)}
    rows.sort(key=lambda r: (-r["weighted_avg_f1"], rank.get(r["model_name"], len(rank))))
    return [r["model_name"] for r in rows[:k]]


def bakeoff(spark: SparkSession, data: Prepared, log_path: str,
            models: list[str] | None = None, tune_top: int = 0, grids: dict | None = None,
            parallelism: int = 4) -> DataFrame:
    """Resumable bake-off.  Models already in the log are skipped (L4);
    each new run appends its row before the next starts, so a crash loses at
    most the model in flight.  With ``tune_top`` > 0, the best untuned models
    are grid-searched (L9, resumed from the ledger beside the log) and logged as
    ``<name>_Tuned``; boosted models searched together each log the time of the
    shared passes.  On so few rows that a boosted fit is one task, the searches
    go on side by side, and a crash loses their refits, not their scores."""
    from . import tuning
    models = models or DEFAULT_MODELS
    pending = [r["model_name"] for r in report.pending_models(spark, models, log_path).collect()]
    for name in pending:
        _, pred, secs = fit_predict(data, name)
        report.append_confusion(spark, log_path, name, pred, data.label)
        report.append_run(spark, log_path, report.run_log_row(pred, name, secs, False, data.label))
        pred.unpersist()
    if tune_top:
        log = report.read_run_log(spark, log_path)
        done = {r["model_name"] for r in log.select("model_name").collect()}
        grids = grids or tuning.PARAM_GRIDS
        top = [n for n in top_models(log, tune_top, models) if f"{n}_Tuned" not in done]
        ledger = f"{log_path}_search"
        # the boosted searches share their passes; each then finds its scores in the ledger
        t0 = time.time()
        boosted = {n: tuning.expand_grid(grids[n]) for n in top if n in BOOSTED}
        if boosted:
            tuning.boosted_scores(data, boosted, ledger=ledger)
        shared = time.time() - t0

        def tuned(name):
            return name, tuning.grid_search(data, name, grids[name], parallelism=parallelism, ledger=ledger)
        with ThreadPool(max(1, len(top)) if data.n_train <= boosting.TASK_ROWS else 1) as pool:
            for name, res in pool.imap(inheritable_thread_target(spark)(tuned), top):
                res.seconds += shared if name in BOOSTED else 0.0
                report.append_confusion(spark, log_path, f"{name}_Tuned", res.test_predictions,
                                        data.label)
                report.append_run(spark, log_path, report.run_log_row(
                    res.test_predictions, f"{name}_Tuned", res.seconds, True, data.label))
    return report.read_run_log(spark, log_path)


def notebook_models(spark: SparkSession, data: Prepared,
                    basic: Prepared | None = None) -> DataFrame:
    """The notebook's comparison on the 70/15/15 split: default logistic
    regression and random forest on the basic 3-feature sessions (when
    ``basic`` is given), then the default and the tuned models on the enriched
    features, each scored on the validation and the test rows."""
    runs = []  # (name, data, model, parameters)
    if basic is not None:
        runs += [("LogisticRegression (basic)", basic, "LogisticRegression", None),
                 ("RandomForest (basic)", basic, "RandomForest", None)]
    runs += [("LogisticRegression", data, "LogisticRegression", None),
             ("RandomForest", data, "RandomForest", None),
             ("XGBoost", data, "XGBoost", None),
             ("RandomForest (Tuned)", data, "RandomForest", EDA_TUNED["RandomForest"]),
             ("XGBoost (Tuned)", data, "XGBoost", EDA_TUNED["XGBoost"])]
    out = None
    for label, d, name, params in runs:
        model = fit_model(d, name, params)
        for split_name, part in (("val", d.val), ("test", d.test)):
            m = report.metrics_frame(model.transform(part), d.label).select(
                F.lit(label).alias("model"), F.lit(split_name).alias("split"),
                "abandoned_precision", "abandoned_recall", "abandoned_f1", "accuracy",
                "weighted_avg_f1")
            out = m if out is None else out.unionByName(m)
    return out


# --------------------------------------------------------------------------- L11/L12
class Champion:
    """The scaler and the boosted ensemble as one saved model (the
    reference saves the booster without its scaler)."""

    def __init__(self, scaler: SQLTransformer, booster: boosting.Boosted):
        self.scaler, self.booster = scaler, booster

    def transform(self, df: DataFrame) -> DataFrame:
        return self.booster.transform(self.scaler.transform(df))

    def save(self, spark: SparkSession, path: str) -> None:
        self.scaler.write().overwrite().save(f"{path}/scaler")
        self.booster.save(spark, f"{path}/booster")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Champion:
        return cls(SQLTransformer.load(f"{path}/scaler"),
                   boosting.Boosted.load(spark, f"{path}/booster"))


def fit_champion(data: Prepared, params: dict | None = None) -> Champion:
    """The champion's parameters on all training rows."""
    return Champion(data.scaler, fit_model(data, "Champion", {**CHAMPION_PARAMS, **(params or {})}))


def save_and_reload(model: Champion, path: str, spark: SparkSession) -> Champion:
    model.save(spark, path)
    return Champion.load(spark, path)


def feature_importance(model: Champion, features: list[str], spark: SparkSession) -> DataFrame:
    """Mean gain per split, scaled to a sum of 1, best first, beside the
    number of splits and the mean and total gain; read from the node table."""
    nodes = model.booster.node_table(spark)
    names = dict(zip(model.booster.features, features))
    plain = nodes.replace(names, subset=["feature"])
    return boosting.importances(plain, features)
