"""Adapter from the driver's synthetic tables to the event schema.

Driver ``events`` (event_id, ts, user_id, event_type, value, props) and
``part`` (p_partkey, p_brand, p_type) are mapped to click events:

* ``click`` becomes ``cart``; other types are kept (``signup``/``error`` are
  "other" types that count as rows but make no output column);
* ``product_id`` is the ``k`` field of ``props``;
* brand / category come from ``part`` and are nulled for every 7th / 5th
  product so distinct counts see nulls;
* ``error`` events carry price 0 so the price filter has work to do;
* a session is one user-day; ``source_month`` splits the stream in two
  halves that stand for the two monthly files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter (must equal the oracle SQL).
MONTH_SPLIT_TS = "2024-01-16 00:00:00"
BRAND_NULL_EVERY = 7
CATEGORY_NULL_EVERY = 5


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


PART_COLUMNS = {"brand", "category_code"}


def adapt_events(events: DataFrame, part: DataFrame | None) -> DataFrame:
    """Driver ``events`` + ``part`` -> T2 event rows (plus ``source_month``).

    Without ``part`` the two columns that come from it are left out.  ``part`` is joined with a plain left equi-join: Spark broadcasts it only
    when its (pruned) size is under ``autoBroadcastJoinThreshold``; otherwise
    it is a shuffle join whose few hot product keys AQE's skew-join splits.
    """
    ev = events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        F.when(F.col("event_type") == "click", F.lit("cart"))
         .otherwise(F.col("event_type")).alias("event_type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        F.when(F.col("event_type") == "error", F.lit(0.0))
         .otherwise(F.col("value")).alias("price"),
        "user_id",
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")).alias("user_session"),
        F.when(F.col("ts") < F.lit(MONTH_SPLIT_TS).cast("timestamp_ntz"), F.lit("A"))
         .otherwise(F.lit("B")).alias("source_month"),
    )
    if part is None:
        return ev.select("source_month", "event_id", "event_time", "event_type", "product_id",
                         "price", "user_id", "user_session")
    pt = part.select(F.col("p_partkey").alias("product_id"), "p_brand", "p_type")
    joined = ev.join(pt, "product_id", "left")
    return joined.select(
        "source_month", "event_id", "event_time", "event_type", "product_id",
        F.when(F.col("product_id") % CATEGORY_NULL_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_type")).alias("category_code"),
        F.when(F.col("product_id") % BRAND_NULL_EVERY == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_brand")).alias("brand"),
        "price", "user_id", "user_session",
    )


def load_events(spark: SparkSession, sf_dir: str, valid_only: bool = False,
                month: str | None = None, columns: list[str] | None = None,
                partitions: int | None = None) -> DataFrame:
    """Adapted event table for a driver scale-factor folder.

    ``columns``: only these event columns; ``part`` is read and joined only
    for brand or category.  ``partitions``: deal the raw rows into that many
    partitions first, for an input of fewer files than there are cores.

    ``valid_only=True`` adds the price rule on the raw columns (``error``
    events carry price 0, the others their ``value``), which Parquet can
    take as pushed filters; ``valid_events`` still applies on top.
    ``month`` ("A" / "B") reads one monthly half as a pushed ``ts`` range,
    the way a month-partitioned table is pruned.
    """
    raw = load_table(spark, sf_dir, "events")
    if valid_only:
        raw = raw.filter((F.col("event_type") != "error") & (F.col("value") > 0)
                         & ~F.isnan("value"))
    if month is not None:
        split = F.lit(MONTH_SPLIT_TS).cast("timestamp_ntz")
        raw = raw.filter(F.col("ts") < split if month == "A" else F.col("ts") >= split)
    if partitions:
        raw = raw.repartition(partitions)
    part = (load_table(spark, sf_dir, "part")
            if columns is None or PART_COLUMNS & set(columns) else None)
    events = adapt_events(raw, part)
    return events if columns is None else events.select(*columns)


# DuckDB form of the same adapter, used as a CTE by every oracle query.
EVENTS_CTE_SQL = f"""
ev0 AS (
  SELECT event_id,
         ts AS event_time,
         CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CASE WHEN event_type = 'error' THEN 0.0 ELSE value END AS price,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS user_session,
         CASE WHEN ts < TIMESTAMP '{MONTH_SPLIT_TS}' THEN 'A' ELSE 'B' END AS source_month
  FROM events
),
ev AS (
  SELECT e.source_month, e.event_id, e.event_time, e.event_type, e.product_id,
         CASE WHEN e.product_id % {CATEGORY_NULL_EVERY} = 0 THEN NULL ELSE p.p_type END AS category_code,
         CASE WHEN e.product_id % {BRAND_NULL_EVERY} = 0 THEN NULL ELSE p.p_brand END AS brand,
         e.price, e.user_id, e.user_session
  FROM ev0 e LEFT JOIN part p ON p.p_partkey = e.product_id
)"""
