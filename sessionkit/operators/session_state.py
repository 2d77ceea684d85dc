"""Stored partial sessions that merge (A6): a new batch of events is added
without reading the earlier ones again.

The state is two Parquet tables in one folder, each with one folder per batch:

``totals``  one row per (batch, session): first and last time, the first user
            with its place in file order, rows, rows per type, price sum, number
            and maximum;
``values``  one row per (batch, session, column, value): the distinct products,
            brands and categories, as rows, so that a session with any number
            of them never sits in one cell.

Every field of ``totals`` merges by a sum, minimum or maximum and ``values`` by
a distinct, so the sessions of all batches are one aggregate over partial rows;
a session that spans batches, or is cut anywhere inside one, comes out exact.
A batch is written under its name: adding it again, after a lost driver say,
replaces it and counts nothing twice.  Batches must hold different events.

Null session keys are no session.  A session without any known user has a null
user; one without prices has null price figures.  An empty batch adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import flag
from ..session import path_exists
from .sessions import LABEL, SEGMENT_COUNT_NAMES, SESSION, _order_key, _type_counts

DISTINCT_COLUMNS = {"product_id": "unique_products", "brand": "unique_brands",
                    "category_code": "unique_categories"}
_SUMS = ["total_events", *SEGMENT_COUNT_NAMES.values(), "price_count", "total_price"]


def partial_totals(events: DataFrame) -> DataFrame:
    """One mergeable row per session of ``events``."""
    first = F.struct(_order_key(events).alias("at"), F.col("user_id"))
    return events.filter(F.col(SESSION).isNotNull()).groupBy(SESSION).agg(
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
        F.min(F.when(F.col("user_id").isNotNull(), first)).alias("first_user"),
        F.count(F.lit(1)).alias("total_events"),
        *_type_counts(SEGMENT_COUNT_NAMES, require_time=False),
        F.count("price").alias("price_count"), F.sum("price").alias("total_price"),
        F.max("price").alias("max_price"))


def merge_totals(partials: DataFrame) -> DataFrame:
    """Partial rows of any batches -> one row per session, itself mergeable."""
    return partials.groupBy(SESSION).agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        F.min("first_user").alias("first_user"),
        *[F.sum(c).alias(c) for c in _SUMS], F.max("max_price").alias("max_price"))


def partial_values(events: DataFrame) -> DataFrame:
    """The distinct (session, column, value) of ``events``, nulls left out."""
    have = [c for c in DISTINCT_COLUMNS if c in events.columns]
    pairs = ", ".join(f"'{c}', cast(`{c}` as string)" for c in have)
    return events.filter(F.col(SESSION).isNotNull()).selectExpr(
        f"`{SESSION}`", f"stack({len(have)}, {pairs}) as (kind, value)") \
        .filter("value is not null").distinct()


class SessionState:
    """The stored state under ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _table(self, name: str, batch: str | None = None) -> str:
        return f"{self.path}/{name}" + (f"/batch={batch}" if batch is not None else "")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._table(name))

    def _write(self, totals: DataFrame, values: DataFrame, batch: str) -> None:
        # totals come last: a batch without them is not complete
        values.write.mode("overwrite").parquet(self._table("values", batch))
        totals.write.mode("overwrite").parquet(self._table("totals", batch))

    def has(self, batch: str) -> bool:
        """Whether the batch was added to its end."""
        return path_exists(self.spark, self._table("totals", batch) + "/_SUCCESS")

    def add(self, events: DataFrame, batch: str) -> None:
        """Store the partial sessions of a batch of events under its name."""
        self._write(partial_totals(events), partial_values(events), batch)

    def compacted(self, path: str) -> "SessionState":
        """A copy under another path with all batches merged into one, so that
        reading stays in proportion to sessions, not to batches.  This state
        stays as it is until the caller drops it."""
        merged = SessionState(self.spark, path)
        merged._write(merge_totals(self._read("totals")),
                      self._read("values").select(SESSION, "kind", "value").distinct(), "merged")
        return merged

    def sessions(self) -> DataFrame:
        """The finished sessions of all batches: the table of ``segment_sessions``."""
        totals = merge_totals(self._read("totals"))
        # Distinct rows first, counts per session after: a session with a third
        # of all values is split by value, then pre-aggregated.
        counts = self._read("values").select(SESSION, "kind", "value").distinct() \
            .groupBy(SESSION).agg(*[F.count_if(F.col("kind") == c).alias(n)
                                    for c, n in DISTINCT_COLUMNS.items()])
        out = totals.join(counts, SESSION, "left").fillna(0, list(DISTINCT_COLUMNS.values()))
        return out.select(
            SESSION, "session_start", "session_end", F.col("first_user.user_id").alias("user_id"),
            "total_events", *SEGMENT_COUNT_NAMES.values(), *DISTINCT_COLUMNS.values(),
            F.try_divide("total_price", "price_count").alias("avg_price"),
            "max_price", "total_price",
            flag((F.col("cart_count") > 0) & (F.col("purchase_count") == 0)).alias(LABEL))
