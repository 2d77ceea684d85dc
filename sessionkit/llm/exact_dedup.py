"""Exact duplicates with a heavy-hitter split, in DataFrame functions only.

1. Every row's SHA-256 is written once, with a row number.
2. A Misra-Gries summary of ``counters`` entries (Spark's mergeable
   ``freqItems``) names every digest that more than 1/``counters`` of the rows
   have; it may name others.
3. The named digests are verified: their exact group size and winner come from
   one aggregate.  These at most ``counters`` rows are broadcast and settle
   their rows on the map side.
4. All other digests have less than 1/``counters`` of the rows each and go
   through an ordinary shuffle.

The row with the largest doc_id of a group stays (nulls count as smallest; of
rows alike in doc_id too, the one read first).  Null texts count as empty;
extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import only

COUNTERS = 1000


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sha, row): the digests of whole texts, written once."""
    rows = only(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
        F.monotonically_increasing_id().alias("row"))
    return materialize(rows, "digests")


def heavy_winners(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Verified (sha, best, size) of the digests the summary names; at most
    ``counters`` rows."""
    spark = digests.sparkSession
    named = digests.stat.freqItems(["sha"], 1.0 / counters).first()[0] or []
    named = spark.createDataFrame([(s,) for s in named if s is not None], "sha string")
    exact = digests.join(F.broadcast(named), "sha").groupBy("sha").agg(
        F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).alias("best"),
        F.count(F.lit(1)).alias("size"))
    return materialize(exact, "heavy")


def exact_duplicates(docs: DataFrame, counters: int = COUNTERS, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = digest_rows(docs, id_col, text_col)
    heavy = heavy_winners(digests, counters)
    settled = digests.join(F.broadcast(heavy), "sha")
    group = Window.partitionBy("sha")
    rest = digests.join(F.broadcast(heavy.select("sha")), "sha", "left_anti").select(
        "sha", "doc_id", "row",
        F.max(F.struct("doc_id", (-F.col("row")).alias("row"))).over(group).alias("best"),
        F.count(F.lit(1)).over(group).alias("size"))
    return settled.unionByName(rest).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("best.row") == -F.col("row")).alias("kept"), F.col("sha").alias("text_sha256"))
