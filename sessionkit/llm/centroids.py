"""Centroid clustering (Lloyd's rounds) with Orchard's nearest-centroid search.

Vectors become integers, floor(scale * x).  Every round sends the k centroids
(at most k x dim numbers) to the tasks.  There, each centroid has the list of
the others sorted by their distance from it.  A vector reads the list of its
current centroid: a centroid not yet visited is marked and measured, and if it
is closer (at equal distance: of smaller number) its own list is taken up from
the top.  The search stops when the next entry of the list lies strictly
beyond twice the current distance, as no centroid from there on can be as
close (triangle inequality), or at the list's end.  All vectors of a batch move
in step, as arrays.

A task adds up the components and members per centroid, Spark adds up the
tasks' sums, and k x dim sums reach the driver, which divides them exactly.  A
hot cluster is thus only a larger sum.  All arithmetic is on integers: 64-bit
where no sum can leave them, else Python's own.

Start: the k vectors with the smallest SHA-256 of ``<seed>:<id>`` (of rows of
one id: by component; null ids last).  Fewer vectors make fewer centroids, an
empty centroid stays where it is.  Null vectors, vectors of another length and
vectors with null or non-finite components take no part; repeated rows take
part each.  Integers, distances and inertias saturate at the ends of a 64-bit
integer.  Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import only

LONG = (1 << 63) - 1


def integer_vectors(table: DataFrame, dim: int, scale: float, id_col: str = "vec_id",
                    vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that take part, as integers."""
    finite = f"size(v) = {dim} and forall(v, x -> x is not null and not isnan(x) " \
             "and abs(cast(x as double)) < double('Infinity'))"
    return only(table, vec_id=id_col, v=vector_col).filter("v is not null").filter(finite).select(
        "vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))


def start_centroids(vectors: DataFrame, k: int, seed: str) -> list:
    """The k vectors of least hash, in its order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.withColumn("key", key).orderBy(F.asc_nulls_last("key"), "v").limit(k).collect()
    return [list(r["v"]) for r in rows]


def _read(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class Orchard:
    """Nearest of ``centroids`` (rows of integers) by neighbour lists."""

    def __init__(self, centroids: list, top: int):
        dim = max(1, len(centroids[0]))
        top = max([top, *(abs(x) for c in centroids for x in c)])
        # a squared distance, and four of them, stay within the type
        self.type = np.int64 if 16 * top * top * dim < LONG else object
        self.centroids = np.array(centroids, dtype=self.type).reshape(len(centroids), -1)
        between = self.measure(self.centroids[:, None], self.centroids[None])
        k = len(centroids)
        others = [sorted((j for j in range(k) if j != c), key=lambda j, c=c: (between[c, j], j))
                  for c in range(k)]
        self.lists = np.array(others, dtype=np.int64).reshape(k, k - 1)
        self.reach = np.array([[between[c, j] for j in others[c]] for c in range(k)],
                              dtype=self.type).reshape(k, k - 1)

    @staticmethod
    def measure(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Squared distances along the last axis."""
        away = a - b
        return np.einsum("...i,...i->...", away, away) if away.dtype != object \
            else (away * away).sum(axis=-1)

    def nearest(self, x: np.ndarray):
        """(centroid, squared distance, distances measured) of every row."""
        x = x.astype(self.type)
        n, k = len(x), len(self.centroids)
        at = np.zeros(n, dtype=np.int64)
        best = self.measure(x, self.centroids[at])
        visited = np.zeros((n, k), dtype=bool)
        visited[:, 0] = True
        place = np.zeros(n, dtype=np.int64)
        open_ = np.arange(n if k > 1 else 0)
        measured = n
        while len(open_):
            c, p = at[open_], place[open_]
            going = self.reach[c, p] <= 4 * best[open_]  # else strictly beyond twice the distance
            open_, c, p = open_[going], c[going], p[going]
            j = self.lists[c, p]
            place[open_] = p + 1
            fresh = ~visited[open_, j]
            rows, j = open_[fresh], j[fresh]
            visited[rows, j] = True
            away = self.measure(x[rows], self.centroids[j])
            measured += len(rows)
            closer = (away < best[rows]) | ((away == best[rows]) & (j < at[rows]))
            rows = rows[closer]
            at[rows], best[rows], place[rows] = j[closer], away[closer], 0
            open_ = open_[place[open_] < k - 1]
        return at, best, measured


def _search(centroids: list, vectors: np.ndarray):
    top = max(abs(int(vectors.max())), abs(int(vectors.min()))) if vectors.size else 0
    return Orchard(centroids, top).nearest(vectors)


def _sums(vectors: DataFrame, centroids: list, dim: int) -> DataFrame:
    """(cluster, i, s, n): the sum of component i and the members."""
    wide = pa.decimal128(38, 0)

    def run(batches):
        sums, counts = {}, {}
        for b in batches:
            x = _read(b.column("v"), dim)
            at, _, _ = _search(centroids, x)
            safe = x.dtype != object and not (x.size and (x.max() >= 1 << 40 or x.min() < -(1 << 40)))
            for c in np.unique(at).tolist():
                part = x[at == c]
                part = part.sum(axis=0).tolist() if safe else part.astype(object).sum(axis=0).tolist()
                sums[c] = [s + int(p) for s, p in zip(sums.get(c, [0] * dim), part)]
                counts[c] = counts.get(c, 0) + int((at == c).sum())
        flat = [(c, i, s, counts[c]) for c, row in sums.items() for i, s in enumerate(row)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[j] for f in flat], t) for j, t in
             enumerate((pa.int32(), pa.int32(), wide, pa.int64()))], names=["cluster", "i", "s", "n"])
    return vectors.select("v").mapInArrow(run, "cluster int, i int, s decimal(38,0), n bigint") \
        .groupBy("cluster", "i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def fit(vectors: DataFrame, k: int, dim: int, rounds: int, seed: str) -> list:
    """The final centroids after ``rounds`` rounds over integer vectors."""
    centroids = start_centroids(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        for r in _sums(vectors, centroids, dim).collect():  # at most k x dim rows
            centroids[r["cluster"]][r["i"]] = int(r["s"]) // r["n"]
    return centroids


def assign(vectors: DataFrame, centroids: list, dim: int) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    def run(batches):
        for b in batches:
            at, best, _ = _search(centroids, _read(b.column("v"), dim))
            best = best if best.dtype != object else np.minimum(best, LONG).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(at, pa.int32()), pa.array(best, pa.int64())],
                names=["vec_id", "cluster", "distance"])
    if not centroids:
        return vectors.select("vec_id", F.lit(0).alias("cluster"),
                              F.lit(0).cast("bigint").alias("distance")).limit(0)
    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(table: DataFrame, k: int = 40, dim: int = 64, rounds: int = 5, seed: str = "2",
            scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per vector: vec_id, cluster, distance, cluster_inertia, inertia,
    centroid_sha256."""
    spark = table.sparkSession
    vectors = integer_vectors(table, dim, scale, id_col, vector_col)
    centroids = fit(vectors, k, dim, rounds, seed)
    found = materialize(assign(vectors, centroids, dim), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    total = min(sum(sums.values()), LONG)
    facts = spark.createDataFrame(
        [(c, min(s, LONG), total,
          hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
