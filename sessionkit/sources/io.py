"""Sources and sinks.

* CSV is read with a declared schema and timestamp format (no inference,
  no first-chunk schema reuse: every split of every file gets the same
  types); file splits replace the reference's 1M-row chunks.
* Parquet is written snappy-compressed and partitioned by ``source_month``
  (one folder per monthly file), so a month is read by partition pruning.
* Type narrowing decides every column's type from ONE aggregate pass
  (min / max / float round-trip error) instead of per chunk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import EVENT_COLUMNS, EVENT_SCHEMA, MONTHLY_CSV_SCHEMA, MONTHLY_CSV_TIMESTAMP_FORMAT

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
# pandas keeps a float64 -> float32 downcast when values stay within this
# absolute tolerance (its float32 check).
FLOAT32_ATOL = 5e-4
LOW_CARDINALITY_RATIO = 0.5

_INT_TYPES = [(T.ByteType(), -(2 ** 7), 2 ** 7 - 1), (T.ShortType(), -(2 ** 15), 2 ** 15 - 1),
              (T.IntegerType(), -(2 ** 31), 2 ** 31 - 1), (T.LongType(), -(2 ** 63), 2 ** 63 - 1)]


# --------------------------------------------------------------------------- S1/S2
def read_events_csv(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                    timestamp_format: str = CSV_TIMESTAMP_FORMAT) -> DataFrame:
    """S1 + S2: CSV with header, declared schema, parsed timestamps."""
    return (spark.read.schema(schema).option("header", True)
            .option("timestampFormat", timestamp_format)
            .option("timestampNTZFormat", timestamp_format)
            .option("mode", "PERMISSIVE").csv(path))


def read_monthly_csv(spark: SparkSession, path: str, month: str) -> DataFrame:
    """S1 for the public monthly files: declared layout, ``... UTC`` times
    parsed as wall-clock ``timestamp_ntz``, ``source_month`` attached, and the
    columns put in event-table order (``category_id`` is not used).

    ``event_id`` is the file-order stand-in for a group's "first" value:
    ``monotonically_increasing_id`` grows with the split and the row within
    it, i.e. with the position in the file."""
    df = read_events_csv(spark, path, MONTHLY_CSV_SCHEMA, MONTHLY_CSV_TIMESTAMP_FORMAT)
    df = (df.withColumn("source_month", F.lit(month))
          .withColumn("event_id", F.monotonically_increasing_id()))
    return df.select(*EVENT_COLUMNS)


def write_csv(df: DataFrame, path: str, timestamp_format: str = CSV_TIMESTAMP_FORMAT) -> None:
    (df.write.mode("overwrite").option("header", True)
     .option("timestampFormat", timestamp_format)
     .option("timestampNTZFormat", timestamp_format).csv(path))


# --------------------------------------------------------------------------- S3/S4
def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Snappy Parquet, one schema for the whole table."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_parquet(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """S3: Parquet scan; ``months`` prunes ``source_month`` partitions."""
    df = spark.read.parquet(path)
    if months is not None:
        df = df.filter(F.col("source_month").isin(months))
    return df


# --------------------------------------------------------------------------- S8/S9
def _narrow_decisions(df: DataFrame) -> list[tuple[str, str, str]]:
    aggs, plan = [], []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            aggs += [F.min(c).alias(f"lo_{f.name}"), F.max(c).alias(f"hi_{f.name}")]
            plan.append((f, "int"))
        elif isinstance(f.dataType, T.DoubleType):
            err = F.abs(c - c.cast("float").cast("double"))
            aggs += [F.max(F.when(~F.isnan(c), err)).alias(f"err_{f.name}"),
                     F.max(F.when(~F.isnan(c), F.abs(c))).alias(f"abs_{f.name}")]
            plan.append((f, "float"))
    if not aggs:
        return []
    row = df.agg(*aggs).first()
    out = []
    for f, kind in plan:
        old = f.dataType.simpleString()
        if kind == "int":
            lo, hi = row[f"lo_{f.name}"], row[f"hi_{f.name}"]
            new = old
            if lo is not None:
                for t, tlo, thi in _INT_TYPES:
                    if tlo <= lo and hi <= thi:
                        new = t.simpleString()
                        break
        else:
            err, mx = row[f"err_{f.name}"], row[f"abs_{f.name}"]
            fits = mx is not None and mx <= 3.4028234663852886e38
            new = "float" if fits and err is not None and err <= FLOAT32_ATOL else old
        out.append((f.name, old, new))
    return out


def narrow_types(df: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Cast numeric columns to the narrowest type holding all values
    (integers by min/max; doubles to float when the float32 round trip
    stays within pandas' tolerance)."""
    decisions = _narrow_decisions(df)
    casts = {name: F.col(f"`{name}`").cast(new) for name, old, new in decisions if new != old}
    return (df.withColumns(casts) if casts else df), decisions


def narrow_report(df: DataFrame) -> DataFrame:
    """Column, old type -> new type (numeric columns only)."""
    decisions = _narrow_decisions(df)
    spark = df.sparkSession
    return spark.createDataFrame(
        [(c, o, n, o != n) for c, o, n in decisions],
        "column_name string, old_type string, new_type string, narrowed boolean")


# --------------------------------------------------------------------------- S10
def low_cardinality(df: DataFrame, threshold: float = LOW_CARDINALITY_RATIO,
                    approx: bool = False) -> DataFrame:
    """Per string column, distinct values / rows and whether it is below
    ``threshold`` (the reference's category-encoding test), one aggregate.
    ``approx=True`` counts distinct values with HyperLogLog++."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[fn(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', d{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, n_distinct)",
                           "__rows AS n_rows")
    ratio = F.col("n_distinct") / F.col("n_rows")
    return long.withColumn("ratio", ratio).withColumn("is_low_cardinality",
                                                      F.col("ratio") < F.lit(threshold))
