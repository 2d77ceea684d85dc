"""Declared schemas (no inference on the hot path)."""

from __future__ import annotations

from pyspark.sql import types as T

# Event table (T2).  ``event_id`` is an optional tie-breaker that stands for
# file order; ``source_month`` names the monthly file an event came from.
EVENT_SCHEMA = T.StructType([
    T.StructField("source_month", T.StringType(), True),
    T.StructField("event_id", T.LongType(), True),
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_session", T.StringType(), True),
])

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# Run log (T9): one row per trained model.
RUN_LOG_SCHEMA = T.StructType(
    [T.StructField("model_name", T.StringType(), False),
     T.StructField("is_tuned", T.BooleanType(), False),
     T.StructField("train_time_sec", T.DoubleType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in (
        "accuracy",
        "abandoned_precision", "abandoned_recall", "abandoned_f1",
        "not_abandoned_precision", "not_abandoned_recall", "not_abandoned_f1",
        "weighted_avg_precision", "weighted_avg_recall", "weighted_avg_f1")]
)

RUN_LOG_COLUMNS = [f.name for f in RUN_LOG_SCHEMA.fields]

# Layout of the public monthly click-event CSV files (one file per month).
MONTHLY_CSV_SCHEMA = T.StructType([
    T.StructField("event_time", T.TimestampNTZType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("category_id", T.LongType(), True),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("brand", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("user_session", T.StringType(), True),
])
MONTHLY_CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
