"""Evaluation and run bookkeeping.

A classification report needs only the 2x2 confusion counts: one
``count_if`` aggregate over the predictions; everything after is arithmetic
on that single row (kept as DataFrame expressions, so the report is itself
a Spark result).  The run log is an append-only CSV table (one part file per
appended run) read back with a declared schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists
from ..sources.schema import RUN_LOG_COLUMNS, RUN_LOG_SCHEMA

# Report row names, as the reference prints them.
CLASS_NAMES = {0: "Not Abandoned (0)", 1: "Abandoned (1)"}
REPORT_METRICS = ["accuracy", "abandoned_precision", "abandoned_recall", "abandoned_f1",
                  "not_abandoned_precision", "not_abandoned_recall", "not_abandoned_f1",
                  "weighted_avg_precision", "weighted_avg_recall", "weighted_avg_f1"]


def _div(a: Column, b: Column) -> Column:
    """x / 0 -> 0 (scikit-learn's ``zero_division`` default outcome)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(pred: DataFrame, label: str = "is_abandoned",
                     prediction: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp (L3b, zero-filled)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    return pred.agg(F.count_if((y == 0) & (p == 0)).alias("tn"),
                    F.count_if((y == 0) & (p == 1)).alias("fp"),
                    F.count_if((y == 1) & (p == 0)).alias("fn"),
                    F.count_if((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(pred: DataFrame, label: str = "is_abandoned",
                     prediction: str = "prediction") -> DataFrame:
    """Long 2x2 matrix (actual, predicted, count)."""
    return confusion_counts(pred, label, prediction).selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, count)")


def metrics_frame(pred: DataFrame, label: str = "is_abandoned",
                  prediction: str = "prediction") -> DataFrame:
    """One wide row with every per-class and averaged metric."""
    c = confusion_counts(pred, label, prediction)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    s1, s0 = tp + fn, tn + fp
    p1, r1 = _div(tp, tp + fp), _div(tp, s1)
    p0, r0 = _div(tn, tn + fn), _div(tn, s0)
    out = c.select(
        "tn", "fp", "fn", "tp",
        _div(tp + tn, n).alias("accuracy"),
        p1.alias("abandoned_precision"), r1.alias("abandoned_recall"),
        p0.alias("not_abandoned_precision"), r0.alias("not_abandoned_recall"),
        s1.alias("support_1"), s0.alias("support_0"), n.alias("n"))
    f1 = lambda p, r: _div(F.lit(2.0) * p * r, p + r)
    out = out.withColumns({
        "abandoned_f1": f1(F.col("abandoned_precision"), F.col("abandoned_recall")),
        "not_abandoned_f1": f1(F.col("not_abandoned_precision"), F.col("not_abandoned_recall")),
    })
    w = lambda a, b: _div(F.col(a) * F.col("support_1") + F.col(b) * F.col("support_0"),
                          F.col("n"))
    return out.withColumns({
        "weighted_avg_precision": w("abandoned_precision", "not_abandoned_precision"),
        "weighted_avg_recall": w("abandoned_recall", "not_abandoned_recall"),
        "weighted_avg_f1": w("abandoned_f1", "not_abandoned_f1"),
        "macro_avg_precision": (F.col("abandoned_precision") + F.col("not_abandoned_precision")) / 2,
        "macro_avg_recall": (F.col("abandoned_recall") + F.col("not_abandoned_recall")) / 2,
        "macro_avg_f1": (F.col("abandoned_f1") + F.col("not_abandoned_f1")) / 2,
    })


def classification_report(pred: DataFrame, label: str = "is_abandoned",
                          prediction: str = "prediction") -> DataFrame:
    """L3: scikit-learn's report as rows (class, precision, recall, f1_score,
    support); the accuracy row carries accuracy in ``f1_score``."""
    m = metrics_frame(pred, label, prediction)
    return m.selectExpr(
        "stack(5, "
        f"'{CLASS_NAMES[0]}', not_abandoned_precision, not_abandoned_recall, not_abandoned_f1, support_0, "
        f"'{CLASS_NAMES[1]}', abandoned_precision, abandoned_recall, abandoned_f1, support_1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), accuracy, n, "
        "'macro avg', macro_avg_precision, macro_avg_recall, macro_avg_f1, n, "
        "'weighted avg', weighted_avg_precision, weighted_avg_recall, weighted_avg_f1, n"
        ") AS (class, precision, recall, f1_score, support)")


def metrics_long(pred: DataFrame, model_name: str, label: str = "is_abandoned",
                 prediction: str = "prediction") -> DataFrame:
    """Abandoned-class precision / recall / F1 in long form (melt)."""
    m = metrics_frame(pred, label, prediction).select(
        F.lit(model_name).alias("model"),
        F.col("abandoned_precision").alias("Precision"),
        F.col("abandoned_recall").alias("Recall"),
        F.col("abandoned_f1").alias("F1-Score"))
    return m.unpivot(["model"], ["Precision", "Recall", "F1-Score"], "metric", "score")


def run_log_row(pred: DataFrame, model_name: str, train_time: float, is_tuned: bool,
                label: str = "is_abandoned", prediction: str = "prediction") -> dict:
    """The 13 logged values of one run, metrics rounded to 4 places."""
    r = metrics_frame(pred, label, prediction).first()
    row = {"model_name": model_name, "is_tuned": bool(is_tuned),
           "train_time_sec": round(float(train_time), 2)}
    row.update({k: round(float(r[k]), 4) for k in REPORT_METRICS})
    return row


# --------------------------------------------------------------------------- S5-S7, L4, L5
def append_run(spark: SparkSession, log_path: str, row: dict) -> None:
    """Append one metrics row (a new CSV part file; header in each)."""
    df = spark.createDataFrame([tuple(row[c] for c in RUN_LOG_COLUMNS)], RUN_LOG_SCHEMA)
    df.coalesce(1).write.mode("append").option("header", True).csv(log_path)


def append_confusion(spark: SparkSession, log_path: str, name: str, pred: DataFrame,
                     label: str = "is_abandoned") -> None:
    """The confusion matrix of one logged run, beside the run log."""
    confusion_matrix(pred, label).select(F.lit(name).alias("model_name"), "actual", "predicted",
                                         F.col("count").cast("bigint").alias("count")) \
        .coalesce(1).write.mode("append").option("header", True).csv(f"{log_path}_confusion")


def read_confusion(spark: SparkSession, log_path: str) -> DataFrame:
    """The confusion matrices of all logged runs."""
    return spark.read.schema("model_name string, actual int, predicted int, count bigint") \
        .option("header", True).csv(f"{log_path}_confusion")


def read_run_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The run log with its declared schema (empty when absent)."""
    if not path_exists(spark, log_path):
        return spark.createDataFrame([], RUN_LOG_SCHEMA)
    return spark.read.schema(RUN_LOG_SCHEMA).option("header", True).csv(log_path)


def pending_models(spark: SparkSession, candidates: list[str], log_path: str) -> DataFrame:
    """L4: candidate names not yet in the log (``left_anti``)."""
    cand = spark.createDataFrame([(i, n) for i, n in enumerate(candidates)],
                                 "run_order int, model_name string")
    done = read_run_log(spark, log_path).select("model_name")
    return cand.join(done, "model_name", "left_anti").orderBy("run_order")


def leaderboard(spark: SparkSession, log_path: str) -> DataFrame:
    """The log sorted by weighted F1 (best first)."""
    return read_run_log(spark, log_path).orderBy(F.desc("weighted_avg_f1"), "model_name")


def write_csv_report(df: DataFrame, path: str) -> None:
    """A small report table (k rows) as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
