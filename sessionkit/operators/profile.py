"""Profiling operators.

All are single aggregate passes (partial aggregation on the map side); the
few that need a global constant (histogram edges, KDE bandwidth, quantiles)
compute it first with a tiny aggregate and inline it as a literal, so no
cross join and no driver-side data loop is involved.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import valid_price
from ..functions.quantiles import quantiles
from ..session import materialize

# The describe() statistics, in pandas order.
DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]
# The five key columns whose distinct counts are profiled.
KEY_COLUMNS = ["user_session", "user_id", "product_id", "category_code", "brand"]
#: Powers of the offset that a cell of the density estimate adds up, and how many bandwidths it reaches.
KDE_TERMS = 16
KDE_REACH = 9.0


def preview(df: DataFrame, n: int = 5, order: list[str] | None = None) -> DataFrame:
    """First ``n`` rows in a stable order (a per-task top-k, then merge)."""
    order = order or [c for c in ("event_time", "event_id") if c in df.columns]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)


def null_profile(df: DataFrame) -> DataFrame:
    """P2 (``info``): column, type and non-null count, one aggregate pass."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)])
    pairs = ", ".join(
        f"'{c}', '{t.simpleString()}', n{i}"
        for i, (c, t) in enumerate((f.name, f.dataType) for f in df.schema.fields))
    return counts.selectExpr(
        f"stack({len(df.columns)}, {pairs}) AS (column_name, data_type, non_null_count)",
        "__rows AS total_rows")


def distinct_counts(df: DataFrame, cols: list[str] | None = None,
                    approx: bool = False) -> DataFrame:
    """Distinct counts of key columns (nulls ignored) in one aggregate.

    ``approx=True`` uses HyperLogLog++ (``approx_count_distinct``), which keeps
    a fixed-size sketch per task instead of Catalyst's Expand of the rows.
    """
    cols = cols or KEY_COLUMNS
    fn = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[fn(c).alias(c) for c in cols])


def value_share(df: DataFrame, col: str, pct: bool = True) -> DataFrame:
    """``value_counts(normalize=True)``: count and share per value.

    The share is a window over the grouped (tiny) result, not over rows.
    """
    g = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    share = F.col("count") / total * (F.lit(100.0) if pct else F.lit(1.0))
    return g.withColumn("percent" if pct else "share", share)


def top_values(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """Most frequent non-null values; ties by value."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col)).limit(n))


def describe(df: DataFrame, cols: list[str], long: bool = True,
             exact: bool = True, cut: bool = True) -> DataFrame:
    """Pandas ``describe``: count, mean, std (sample), min,
    quartiles (linear interpolation, exact), max.

    The moments and the quantiles each read the columns.  With ``cut`` these
    are written once, for tables that cost more to make than to write; a scan
    of a few columns is rather read twice (``cut=False``)."""
    clean = df.select([
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
        for c in cols])
    if cut:
        clean = materialize(clean, "described")
    q = quantiles(clean, cols, [0.25, 0.5, 0.75], exact=exact)
    aggs = []
    for c in cols:
        aggs += [F.count(c).cast("double").alias(f"{c}|count"),
                 F.avg(c).alias(f"{c}|mean"),
                 F.stddev_samp(c).alias(f"{c}|std"),
                 F.min(c).alias(f"{c}|min"),
                 F.max(c).alias(f"{c}|max")]
    wide = clean.agg(*aggs)
    for c in cols:
        for p, v in zip(("25%", "50%", "75%"), q[c]):
            wide = wide.withColumn(f"{c}|{p}", F.lit(v).cast("double"))
    if not long:
        return wide
    pairs = ", ".join(f"'{c}', '{s}', `{c}|{s}`" for c in cols for s in DESCRIBE_STATS)
    return wide.selectExpr(
        f"stack({len(cols) * len(DESCRIBE_STATS)}, {pairs}) AS (feature, statistic, value)")


def zero_price_by_type(events: DataFrame) -> DataFrame:
    """Events with price exactly 0, by type."""
    return (events.filter(F.col("price") == 0).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("count")))


def clean_counts(events: DataFrame) -> DataFrame:
    """Rows before / after the price filter, one pass."""
    return events.agg(F.count(F.lit(1)).alias("rows_before"),
                      F.count_if(valid_price("price")).alias("rows_after")
                      ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def _min_max(df: DataFrame, col: str) -> tuple[float, float]:
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    return row["lo"], row["hi"]


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """P10: equal-width histogram over [min, max], the maximum in the last
    bin (``width_bucket`` would put it in bin ``bins + 1``).  Empty bins are
    kept (a ``bins``-row range left-joined to the counts)."""
    x = F.col(col).cast("double")
    data = df.filter(x.isNotNull() & ~F.isnan(x))
    lo, hi = _min_max(data, col)
    spark = df.sparkSession
    if lo is None:
        return spark.range(0).select(F.col("id").cast("int").alias("bin"))
    span = float(hi) - float(lo)
    scale = bins / span if span > 0 else 0.0
    raw = F.floor((x - F.lit(float(lo))) * F.lit(scale)).cast("int")
    idx = F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))
    counts = data.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = span / bins
    edges = (spark.range(bins).select(F.col("id").cast("int").alias("bin"))
             .withColumn("bin_lo", F.col("bin").cast("double") * F.lit(width) + F.lit(float(lo)))
             .withColumn("bin_hi", (F.col("bin") + 1).cast("double") * F.lit(width)
                         + F.lit(float(lo))))
    return (edges.join(counts, "bin", "left")
            .withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint")))


def kde(df: DataFrame, col: str, grid: int = 200, bins: int | None = None) -> DataFrame:
    """Gaussian kernel density on ``grid`` points over [min, max] with
    Scott's bandwidth ``std * n ** (-1/5)``; ``bins`` scales the curve to the
    counts of a histogram of that many bins over the same range.

    A fast Gauss transform: the rows fall into cells one bandwidth wide, one
    aggregate adds up the first ``KDE_TERMS`` powers of the offset t from the
    cell's middle (|t| <= 1/2 bandwidths), and a cell gives to a point s
    bandwidths away exp(-s^2 / 2) * sum_n He_n(s) / n! * (sum of t^n).  The
    terms left out are below 1.09 * (1/2)^n / sqrt(n!) each, under 4e-12 of a
    row's peak together; cells over ``KDE_REACH`` bandwidths away give under
    3e-18 of it.  So the cost follows rows, and the pairs of cells and points
    near them, not rows x points.
    """
    x = F.col(col).cast("double")
    data = df.filter(x.isNotNull() & ~F.isnan(x))
    stats = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(x).alias("sd"),
                     F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    n, sd, lo, hi = stats["n"], stats["sd"], stats["lo"], stats["hi"]
    spark = df.sparkSession
    if not n or sd is None or sd == 0:
        return spark.range(0).select(F.col("id").cast("int").alias("point"))
    h = sd * n ** (-1.0 / 5.0)
    step = (hi - lo) / (grid - 1)
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    if bins:
        norm *= n * (hi - lo) / bins
    place = data.select(((x - F.lit(lo)) / F.lit(h)).alias("p")) \
        .select(F.floor("p").alias("cell"), (F.col("p") - F.floor("p") - 0.5).alias("t"))
    cells = place.groupBy("cell").agg(*[F.sum(F.pow("t", F.lit(float(i)))).alias(f"m{i}")
                                        for i in range(KDE_TERMS)])
    middle = (F.col("cell") + 0.5) * F.lit(h)  # from lo
    first = F.greatest(F.ceil((middle - KDE_REACH * h) / step), F.lit(0))
    last = F.least(F.floor((middle + KDE_REACH * h) / step), F.lit(grid - 1))
    near = cells.withColumn("point", F.explode(F.when(first <= last, F.sequence(first, last)))) \
        .withColumn("s", F.col("point") * F.lit(step / h) - F.col("cell") - 0.5)
    given = F.exp(-0.5 * F.col("s") * F.col("s")) * sum(
        (F.col(f"m{i}") * he / math.factorial(i) for i, he in enumerate(_hermite(F.col("s")))), F.lit(0.0))
    sums = near.groupBy("point").agg(F.sum(given).alias("d"))
    return (spark.range(grid).withColumnRenamed("id", "point").join(sums, "point", "left")
            .select(F.col("point").cast("int").alias("point"),
                    (F.col("point") * F.lit(step) + F.lit(lo)).alias("x"),
                    (F.coalesce("d", F.lit(0.0)) * F.lit(norm)).alias("density")))


def _hermite(s: Column) -> list:
    """The Hermite polynomials He_0(s) .. as columns, by Horner's rule."""
    rows = [[1], [0, 1]]  # coefficients, lowest power first
    while len(rows) < KDE_TERMS:
        up, low, k = [0, *rows[-1]], rows[-2], len(rows) - 1
        rows.append([c - k * (low[i] if i < len(low) else 0) for i, c in enumerate(up)])
    out = []
    for row in rows:
        value = F.lit(0.0)
        for c in reversed(row):
            value = value * s + F.lit(float(c))
        out.append(value)
    return out


def means_by(df: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Feature means per outcome."""
    return df.groupBy(by).agg(*[F.avg(c).alias(c) for c in cols])


def shape(df: DataFrame, name: str | None = None) -> DataFrame:
    """(rows, columns) of a table as a one-row DataFrame."""
    out = df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))
    return out if name is None else out.select(F.lit(name).alias("name"), "rows", "columns")


def split_shapes(df: DataFrame, split_col: str = "split", label: str | None = None) -> DataFrame:
    """P16 for a split table: rows per split, and feature columns (excluding
    the split column and the label)."""
    feature_cols = [c for c in df.columns if c not in (split_col, label)]
    return (df.groupBy(split_col).agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("columns", F.lit(len(feature_cols))))
