"""Connected components of an edge table by alternating star contractions.

Large-star links every neighbour above a node to the least of its
neighbourhood, small-star those below; after a logarithmic number of rounds
every node points to the least node of its component.  Each round is two
joins on the node and is written to the shared checkpoint folder, so that a
lost executor costs one round at most.  Minima are combined map-side, and the
joins are plain sort-merge joins whose hot nodes AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) of any comparable type -> (node, root), one row per
    node that has an edge to another, root the least node it reaches.
    Loops, repeated and null edges are harmless."""
    cur = materialize(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u is not null and v is not null and u <> v").distinct(), "edges")
    state = _state(cur)
    while state[0]:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")) \
            .select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(least.select("u", F.col("m").alias("v")))
        cur = materialize(small.filter("u <> v").distinct(), "small-star")
        before, state = state, _state(cur)
        if state == before:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
