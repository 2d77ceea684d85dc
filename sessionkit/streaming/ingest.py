"""Incremental ingestion of monthly CSV drops into the Parquet event table.

The reference converts each monthly CSV to Parquet chunk by chunk.  Here the
CSV folder is a Structured Streaming file source with a declared schema and
``trigger(availableNow=True)``: every run converts exactly the files not yet
seen (tracked in the checkpoint), writes snappy Parquet partitioned by
``source_month``, and stops.  A crashed run resumes from its checkpoint with
no duplicate rows (the file sink is exactly-once).

With ``rejects_dir`` the same stream sets aside the rows that do not parse.
Each micro-batch then overwrites its own ``ingest_batch=<n>`` folders of the
table and of the rejects, so a batch that is run again replaces itself.  A
reject has its file, its raw line, and the reason: the columns whose text is
not of their type, or ``fields`` for a line of another number of fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import file_system, materialize
from ..sources.io import CSV_TIMESTAMP_FORMAT
from ..sources.schema import (EVENT_COLUMNS, EVENT_SCHEMA, MONTHLY_CSV_SCHEMA,
                              MONTHLY_CSV_TIMESTAMP_FORMAT)

# The month of a monthly file, taken from its name (e.g. "2019-Oct.csv").
MONTH_FROM_FILE = r"(\d{4}-[A-Za-z]{3})"


def _last_batch(spark: SparkSession, checkpoint_dir: str) -> int:
    """Number of the last committed micro-batch; -1 before the first."""
    fs, path = file_system(spark, f"{checkpoint_dir.rstrip('/')}/commits")
    if not fs.exists(path):
        return -1
    names = [f.getPath().getName() for f in fs.listStatus(path)]
    return max([int(n) for n in names if n.isdigit()], default=-1)


CORRUPT = "corrupt_record"


def rejected_rows(parsed: DataFrame, schema: T.StructType) -> DataFrame:
    """``file, line, reason`` of the rows of ``parsed`` with a corrupt record."""
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    tokens = F.from_csv(CORRUPT, raw.simpleString()[len("struct<"):-1].replace(":", " "))
    bad = parsed.filter(F.col(CORRUPT).isNotNull()).withColumn("tokens", tokens)
    wrong = F.concat_ws(",", *[F.when(F.col(f"tokens.`{f.name}`").isNotNull() & F.col(f"`{f.name}`").isNull(),
                                      F.lit(f.name)) for f in schema.fields])
    return bad.select("file", F.col(CORRUPT).alias("line"),
                      F.when(wrong == "", F.lit("fields")).otherwise(wrong).alias("reason"))


def reject_counts(spark: SparkSession, table_dir: str, rejects_dir: str) -> DataFrame:
    """Rows per micro-batch: kept ones (null reason) and rejects by reason."""
    kept = spark.read.parquet(table_dir).groupBy("ingest_batch").agg(F.count(F.lit(1)).alias("rows")) \
        .withColumn("reason", F.lit(None).cast("string"))
    bad = spark.read.parquet(rejects_dir).groupBy("ingest_batch", "reason") \
        .agg(F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(bad).select("ingest_batch", "reason", "rows")


def _split_batch(table_dir: str, rejects_dir: str, schema: T.StructType,
                 partition_by: tuple[str, ...], finish):
    """The ``foreachBatch`` function that writes kept rows and rejects."""
    def write(batch: DataFrame, number: int) -> None:
        batch = materialize(batch, "ingest-batch")  # parsed once, with every column: no field is pruned
        kept = finish(batch.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
        writer = kept.write.mode("overwrite").option("compression", "snappy")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{table_dir.rstrip('/')}/ingest_batch={number}")
        rejected_rows(batch, schema).write.mode("overwrite") \
            .parquet(f"{rejects_dir.rstrip('/')}/ingest_batch={number}")
    return write


def ingest_csv(spark: SparkSession, source_dir: str, table_dir: str, checkpoint_dir: str,
               schema: T.StructType = EVENT_SCHEMA,
               timestamp_format: str = CSV_TIMESTAMP_FORMAT,
               partition_by: tuple[str, ...] = ("source_month",),
               max_files_per_trigger: int | None = None,
               monthly_layout: bool = False, rejects_dir: str | None = None) -> int:
    """Convert all new CSV files under ``source_dir``; returns the number of
    micro-batches run.  ``monthly_layout=True`` reads the public monthly
    files (no ``source_month`` column: it comes from the file name).  Rows that
    do not parse keep nulls in the table, or go to ``rejects_dir`` if given."""
    if monthly_layout:
        schema, timestamp_format = MONTHLY_CSV_SCHEMA, MONTHLY_CSV_TIMESTAMP_FORMAT
    read_schema = schema if rejects_dir is None else \
        T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = (spark.readStream.schema(read_schema).option("header", True)
              .option("columnNameOfCorruptRecord", CORRUPT)
              .option("timestampFormat", timestamp_format)
              .option("timestampNTZFormat", timestamp_format))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.csv(source_dir)

    def finish(rows: DataFrame) -> DataFrame:
        if not monthly_layout:
            return rows.select(*[f.name for f in schema.fields])
        return (rows.withColumn("source_month", F.regexp_extract("file_name", MONTH_FROM_FILE, 1))
                # no file-order id in a stream: "first" falls back to event_time
                .withColumn("event_id", F.lit(None).cast("long"))
                .select(*EVENT_COLUMNS))

    stream = stream.withColumn("file", F.col("_metadata.file_path")) \
        .withColumn("file_name", F.col("_metadata.file_name"))
    if rejects_dir is None:
        writer = finish(stream).writeStream.format("parquet").option("compression", "snappy")
        writer = writer.option("path", table_dir)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
    else:
        writer = stream.writeStream.foreachBatch(
            _split_batch(table_dir, rejects_dir, schema, partition_by, finish))
    writer = writer.option("checkpointLocation", checkpoint_dir).trigger(availableNow=True)
    before = _last_batch(spark, checkpoint_dir)
    writer.start().awaitTermination()  # raises if the query failed
    return _last_batch(spark, checkpoint_dir) - before
