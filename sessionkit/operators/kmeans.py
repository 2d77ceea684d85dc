"""K-means with many starts that advance together (K3).

All starts share every pass over the vectors: a pass adds up, per (start,
cluster), the rows, the vectors and the squared distances to the nearest
centre, and Spark adds up the tasks' sums; starts x clusters rows reach the
driver.  So ten starts cost the passes of the longest one, not of all ten.

Seeds follow k-means++ (a vector is drawn in proportion to its squared distance
to the centres so far), drawn by hash: vector i gets the uniform number u of a
hash of (start, step, key), and the least -ln(u) / distance wins, which draws
with just those weights, in one pass a step for all starts, and alike for any
partitioning.  Ties go to the smaller vector; one at distance 0 is drawn only
where all are.

Vectors with a null or NaN component take no part.  With fewer distinct vectors
than clusters some centres coincide and the later ones stay empty; an empty
cluster keeps its centre.  Repeated rows weigh as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, share_package

ROWS = 4096  # vectors of one block of distances


@dataclass
class Start:
    """One start: its number, centres (k x dim), cost, and Lloyd steps taken."""
    number: int
    centers: np.ndarray
    cost: float = float("inf")
    steps: int = 0
    done: bool = False


def vectors(matrix: DataFrame, cols: list[str], key: str) -> DataFrame:
    """``key, v`` of the rows without a missing component."""
    doubles = [F.col(f"`{c}`").cast("double") for c in cols]
    whole = matrix.select(F.col(f"`{key}`").cast("string").alias("key"), F.array(*doubles).alias("v"))
    return whole.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x)))


def _blocks(batches, dim: int):
    """(first column, rows x dim array) of small blocks of each Arrow batch."""
    for b in batches:
        for a in range(0, b.num_rows, ROWS):
            part = b.slice(a, ROWS)
            yield part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, rows x centres, added up component by component."""
    d = np.zeros((len(x), len(centers)))
    for j in range(x.shape[1]):
        d += (x[:, j, None] - centers[None, :, j]) ** 2
    return d


def lloyd_sums(vecs: DataFrame, centers: list) -> DataFrame:
    """One pass for several starts: ``start, cluster, n, sums, cost`` of the
    vectors by their nearest centre (ties: smaller number); no empty clusters."""
    dim, k = centers[0].shape[1], len(centers[0])

    def run(batches):
        n = np.zeros((len(centers), k), dtype=np.int64)
        sums, cost = np.zeros((len(centers), k, dim)), np.zeros((len(centers), k))
        for _, x in _blocks(batches, dim):
            for s, c in enumerate(centers):
                d = _distances(x, c)
                near = d.argmin(axis=1)
                n[s] += np.bincount(near, minlength=k)
                cost[s] += np.bincount(near, weights=d[np.arange(len(x)), near], minlength=k)
                for j in range(dim):
                    sums[s, :, j] += np.bincount(near, weights=x[:, j], minlength=k)
        at = np.argwhere(n > 0)
        if len(at):
            s, c = at.T
            yield pa.RecordBatch.from_arrays(
                [pa.array(s, pa.int32()), pa.array(c, pa.int32()), pa.array(n[s, c]),
                 pa.array(list(sums[s, c]), pa.list_(pa.float64())), pa.array(cost[s, c])],
                names=["start", "cluster", "n", "sums", "cost"])

    share_package(vecs.sparkSession)
    per_task = vecs.select("key", "v").mapInArrow(
        run, "start int, cluster int, n bigint, sums array<double>, cost double")
    return per_task.groupBy("start", "cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[j]) for j in range(dim)]).alias("sums"),
        F.sum("cost").alias("cost"))


def _draw(vecs: DataFrame, chosen: list, n_starts: int, dim: int, salt: str) -> list:
    """One k-means++ step for all starts: the vector each draws."""
    step = len(chosen[0]) if chosen else 0

    def run(batches):
        best: dict = {}
        for u, x in _blocks(batches, dim):
            u = u.flatten().to_numpy(zero_copy_only=False).reshape(-1, n_starts)
            for s in range(n_starts):
                d = _distances(x, np.array(chosen[s])).min(axis=1) if step else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    race = -np.log(u[:, s]) / d  # infinite at distance 0
                first = race == race.min()
                drawn = float(race.min()), min(x[first].tolist())
                best[s] = min(best.get(s, drawn), drawn)
        if best:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(best), pa.int32()), pa.array([r for r, _ in best.values()]),
                 pa.array([v for _, v in best.values()], pa.list_(pa.float64()))],
                names=["start", "race", "v"])

    # 52 bits of a hash as a number inside (0, 1)
    uniform = F.array(*[
        ((F.shiftrightunsigned(F.xxhash64(F.lit(f"{salt}:{s}:{step}"), "key"), 12)).cast("double") + 0.5)
        / float(2 ** 52) for s in range(n_starts)])
    share_package(vecs.sparkSession)
    won = vecs.select(uniform.alias("u"), "v").mapInArrow(run, "start int, race double, v array<double>") \
        .groupBy("start").agg(F.min(F.struct("race", "v")).alias("won")).collect()  # one row a start
    return [list(r["won"]["v"]) for r in sorted(won, key=lambda r: r["start"])]


def seed_starts(vecs: DataFrame, k: int, n_starts: int, dim: int, salt: str = "kmeans") -> list[Start]:
    """k-means++ seeds of every start: one pass per centre, for all starts."""
    chosen: list = []
    for _ in range(k):
        drawn = _draw(vecs, chosen, n_starts, dim, salt)
        chosen = [c + [v] for c, v in zip(chosen or [[]] * n_starts, drawn)]
    return [Start(i, np.array(c)) for i, c in enumerate(chosen)]


def fit_starts(matrix: DataFrame, cols: list[str], k: int, n_starts: int = 10, max_steps: int = 300,
               rel_tol: float = 1e-4, key: str = "user_session", salt: str = "kmeans") -> list[Start]:
    """All starts of k-means, best first (least cost; ties: smaller number).

    A start is done when its centres together move by at most ``rel_tol`` x the
    mean variance of the components (squared), as scikit-learn counts; the
    others go on.  An empty table gives an empty list.  The vectors are written
    once to the shared checkpoint folder, so a lost executor reads them again.
    """
    vecs = materialize(vectors(matrix, cols, key), "kmeans-vectors")
    dim = len(cols)
    variance = vecs.agg(F.count(F.lit(1)), *[F.var_pop(F.col("v")[j]) for j in range(dim)]).first()
    if not variance[0]:
        return []
    tol = rel_tol * sum(variance[1:]) / dim
    starts = seed_starts(vecs, k, n_starts, dim, salt)
    for _ in range(max_steps):
        open_ = [s for s in starts if not s.done]
        if not open_:
            break
        moved = [s.centers.copy() for s in open_]
        for r in lloyd_sums(vecs, [s.centers for s in open_]).collect():  # starts x k rows
            moved[r["start"]][r["cluster"]] = np.array(r["sums"]) / r["n"]
        for s, c in zip(open_, moved):
            s.done = float(((c - s.centers) ** 2).sum()) <= tol
            s.centers, s.steps = c, s.steps + 1
    cost = [0.0] * n_starts
    for r in lloyd_sums(vecs, [s.centers for s in starts]).collect():
        cost[r["start"]] += r["cost"]
    for s, c in zip(starts, cost):
        s.cost = c
    return sorted(starts, key=lambda s: (s.cost, s.number))
