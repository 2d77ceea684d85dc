"""Exact quantiles by one range-partitioned selection, for any table size.

All columns and ranks are answered by the same few jobs:

1. the columns are unpivoted to (column, value) and counted per distinct value
   (partial aggregation on the map side, so ties of any size cost one row);
2. the distinct values are range-partitioned by (column, value) and written
   once, each with the number of its partition;
3. the rows per partition and column, summed over the partitions before, give
   the partition that holds a wanted rank: partitions x columns numbers,
   reduced in Spark to one row per wanted rank;
4. in those partitions alone, the running count picks the value whose range of
   ranks holds the wanted one.

Interpolation follows numpy's ``linear`` method (the reference's pandas /
scikit-learn quantiles); the discrete rank follows SQL ``percentile_disc``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _lerp(a: float, b: float, t: float) -> float:
    """numpy's linear interpolation (symmetric form)."""
    d = b - a
    return a + d * t if t < 0.5 else b - d * (1.0 - t)


class ValueCounts:
    """The counted, range-partitioned distinct values of some columns."""

    def __init__(self, df: DataFrame, cols: list[str]):
        self.cols = list(dict.fromkeys(cols))
        pairs = ", ".join(f"{i}, cast(`{c}` as double)" for i, c in enumerate(self.cols))
        values = df.selectExpr(f"stack({len(self.cols)}, {pairs}) as (c, v)") \
            .filter("v is not null and not isnan(v)")
        counted = values.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        self.values = materialize(
            counted.repartitionByRange("c", "v").withColumn("part", F.spark_partition_id()),
            "value-counts")
        per_part = self.values.groupBy("c", "part").agg(F.sum("n").alias("n"))
        before = Window.partitionBy("c").orderBy("part")
        self.parts = materialize(per_part.withColumn(
            "upto", F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, 0))), "value-parts")
        found = {r["c"]: r["n"] for r in
                 self.parts.groupBy("c").agg(F.max("upto").alias("n")).collect()}
        self.counts = {c: found.get(i, 0) for i, c in enumerate(self.cols)}

    def select(self, targets: set[tuple[str, int]]) -> dict:
        """{(column, rank): value} for 0-based ranks below the column's count."""
        targets = {t for t in targets if t[1] < self.counts[t[0]]}
        if not targets:
            return {}
        number = {c: i for i, c in enumerate(self.cols)}
        spark = self.values.sparkSession
        wanted = spark.createDataFrame([(number[c], int(r)) for c, r in targets],
                                       "c int, rank bigint")
        hits = self.parts.join(F.broadcast(wanted), "c").filter(
            (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))) \
            .select("c", "part", "rank", (F.col("upto") - F.col("n")).alias("base"))
        ranks = hits.groupBy("c", "part", "base").agg(F.collect_list("rank").alias("ranks"))
        run = F.sum("n").over(Window.partitionBy("c", "part").orderBy("v")
                              .rowsBetween(Window.unboundedPreceding, 0))
        rows = self.values.join(F.broadcast(ranks), ["c", "part"]) \
            .withColumn("upto", F.col("base") + run) \
            .withColumn("rank", F.explode(F.expr(
                "filter(ranks, r -> r < upto and r >= upto - n)")))
        return {(self.cols[r["c"]], r["rank"]): r["v"] for r in rows.select("c", "rank", "v").collect()}


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    discrete: bool = False) -> dict[str, list]:
    """Exact quantiles of each column (nulls and NaN ignored).

    ``discrete=False``: linear interpolation between order statistics
    (numpy / pandas / DuckDB ``quantile_cont``).
    ``discrete=True``: SQL ``percentile_disc`` (0-based rank ceil(p*n)-1).
    """
    values = ValueCounts(df, cols)
    plan: dict[str, list] = {}
    targets = set()
    for c in cols:
        n = values.counts[c]
        plan[c] = []
        for p in probs:
            if n == 0:
                plan[c].append(None)
                continue
            if discrete:
                k = max(math.ceil(p * n) - 1, 0)
                plan[c].append((k, k, 0.0))
                targets.add((c, k))
            else:
                h = (n - 1) * p
                lo, hi = math.floor(h), math.ceil(h)
                plan[c].append((lo, hi, h - lo))
                targets.update({(c, lo), (c, hi)})
    stats = values.select(targets)
    out: dict[str, list] = {}
    for c in cols:
        vals = []
        for item in plan[c]:
            if item is None:
                vals.append(None)
                continue
            lo, hi, t = item
            a, b = stats[(c, lo)], stats[(c, hi)]
            vals.append(a if discrete or lo == hi else _lerp(float(a), float(b), t))
        out[c] = vals
    return out


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                     accuracy: int = 10_000) -> dict[str, list]:
    """One-pass approximate quantiles (``percentile_approx``; rank error at
    most n / accuracy), for when exactness is not needed."""
    clean = df.select([F.when(~F.isnan(F.col(c).cast("double")), F.col(c)).alias(c)
                       for c in cols])
    row = clean.agg(*[F.percentile_approx(c, list(probs), accuracy).alias(c) for c in cols]).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(probs) for c in cols}


def quantiles(df: DataFrame, cols: list[str], probs: list[float], exact: bool = True) -> dict[str, list]:
    """Exact (default) or approximate quantiles of each column."""
    if exact:
        return exact_quantiles(df, cols, probs)
    return approx_quantiles(df, cols, probs)
