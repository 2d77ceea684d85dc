"""Exact top-k inner products by no-random-access aggregation.

Vectors become integers, floor(scale * x).  Candidates are dealt into blocks
of ``block`` rows and queries into blocks of ``query_block``, and each pair of
blocks is a group of its own, so a task never holds more than two blocks.

In a group every dimension is a list of the candidates sorted by their value,
read from the top where the query's component is positive and from the bottom
where it is negative.  All lists are read to the same growing depth.  A
candidate's lower bound takes its read entries and, for the others, the least
entry of the list; its upper bound takes the last entry read.  Candidates, and
with them all that no list has shown yet, are out once their upper bound is
under the k-th lower bound; a query stops reading when at most ``RESOLVE * k``
remain, and their final scores are summed up.  A query that is still open
after the last depth sums up the scores of all that remain, and of no others.

What a list has shown to a depth is the same for all queries that read it from
that end, so the bounds of all open queries are products of their positive and
negative parts with the block's read-so-far vectors, in floating point of
enough bits for the integers to be exact.  The best k of each group meet in a
ranking per query.

Null vectors and vectors with null or non-finite components take no part;
vectors only meet vectors of their length.  Values and scores saturate at the
ends of a 64-bit integer.  Ties go to the smaller vec_id (nulls last, then the
row read first).  Of repeated vec_ids each row is a query or candidate of its
own, and a query never meets its own row.  Extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import only

RESOLVE = 4
DEPTHS = (0.25, 0.5, 0.75, 0.875, 0.9375, 0.96875)
#: Sums below these are exact in the type.
EXACT = ((1 << 24, np.float32), (1 << 53, np.float64))
LONG = (1 << 63) - 1


class SortedLists:
    """A candidate block as one sorted list per dimension."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.sorted = np.sort(vectors, axis=0)

    def bounds(self, queries: np.ndarray, depth: int):
        """(query, candidate) lower and upper bounds after ``depth`` entries of
        every list; entries equal to the last one read count as read."""
        x, lists = self.vectors, self.sorted
        up, down = np.maximum(queries, 0), np.maximum(-queries, 0)
        top, bottom = lists[len(x) - depth], lists[depth - 1]
        upper = up @ np.maximum(x, top).T - down @ np.minimum(x, bottom).T
        lower = up @ np.where(x >= top, x, lists[0]).T - down @ np.where(x <= bottom, x, lists[-1]).T
        return lower, upper

    def best(self, queries: np.ndarray, k: int, own: np.ndarray, tie: np.ndarray):
        """Yield (query, rows, scores) of the k best rows; ``own`` is the row a
        query must not meet, or -1; ``tie`` breaks ties."""
        n = len(self.vectors)
        open_ = np.arange(len(queries))
        apart = np.full((len(queries), n), False)
        apart[own >= 0, own[own >= 0]] = True
        alive = ~apart
        for part in DEPTHS:
            depth = int(n * part)
            if not depth or not len(open_) or n <= k:
                continue
            lower, upper = self.bounds(queries[open_], depth)
            lower[apart[open_]] = -np.inf
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
            alive[open_] &= upper >= kth[:, None]
            few = alive[open_].sum(axis=1) <= RESOLVE * k
            for q in open_[few]:
                rows = np.flatnonzero(alive[q])
                yield self._ranked(q, rows, self.vectors[rows] @ queries[q], k, tie)
            open_ = open_[~few]
        for q in open_:
            rows = np.flatnonzero(alive[q])
            score = self.vectors[rows] @ queries[q]
            if len(rows) > k:
                keep = score >= np.partition(score, len(rows) - k)[len(rows) - k]
                rows, score = rows[keep], score[keep]
            yield self._ranked(q, rows, score, k, tie)

    @staticmethod
    def _ranked(q, rows, score, k, tie):
        at = np.lexsort((tie[rows], -score))[:k]
        return q, rows[at], score[at]


def _group(cand: pa.Table, queries: pa.Table, k: int):
    """(query row, query_id, row, vec_id, score) of one pair of blocks."""
    out = []
    if cand.num_rows and queries.num_rows:
        dim = cand.column("dim")[0].as_py()
        read = lambda t: t.column("v").combine_chunks().flatten().to_numpy(
            zero_copy_only=False).reshape(t.num_rows, dim)
        vectors, asked = read(cand), read(queries)
        rows, asked_rows = (t.column("row").to_numpy() for t in (cand, queries))
        ids, query_ids = (t.column("vec_id").to_pylist() for t in (cand, queries))
        tie = np.empty(len(ids), dtype=np.int64)
        tie[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, rows[i]))] = \
            np.arange(len(ids))
        place = {r: i for i, r in enumerate(rows.tolist())}
        own = np.array([place.get(r, -1) for r in asked_rows.tolist()])
        top = max([1, *(int(abs(int(f(x)))) for x in (vectors, asked) if x.size
                        for f in (np.min, np.max))])
        exact = next((t for limit, t in EXACT if 2 * top * top * max(dim, 1) < limit), None)
        if exact:
            found = SortedLists(vectors.astype(exact)).best(asked.astype(exact), k, own, tie)
        else:  # beyond 53-bit sums: exact Python integers
            found = _by_integers(vectors.tolist(), asked.tolist(), k, own, tie)
        for q, best, score in found:
            out += [(int(asked_rows[q]), query_ids[q], int(rows[i]), ids[i], int(x))
                    for i, x in zip(best, score)]
    cols = list(zip(*out)) or [()] * 5
    return pa.table({n: pa.array(c, pa.int64()) for n, c in
                     zip(("query_row", "query_id", "row", "vec_id", "score"), cols)})


def _by_integers(vectors: list, asked: list, k: int, own, tie):
    for q, query in enumerate(asked):
        every = [(-sum(a * b for a, b in zip(v, query)), tie[i], i)
                 for i, v in enumerate(vectors) if i != own[q]]
        best = sorted(every)[:k]
        yield q, [i for _, _, i in best], [max(-LONG - 1, min(LONG, -s)) for s, _, _ in best]


def top_k(table: DataFrame, is_query, k: int = 5, scale: float = 256.0, block: int = 2048,
          query_block: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """``is_query``: condition on vec_id.  Rows query_id, rank, vec_id, score."""
    finite = "v is not null and forall(v, x -> x is not null and not isnan(x) " \
             "and abs(cast(x as double)) < double('Infinity'))"
    vectors = materialize(
        only(table, vec_id=id_col, v=vector_col).filter(finite)
        .select("vec_id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
        .withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id()),
        "vectors")
    queries = vectors.filter(is_query).select(*[F.col(c).alias(c) for c in vectors.columns])
    # blocks of each kind, per vector length
    sizes = vectors.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"),
        F.ceil(F.count_if(is_query) / query_block).cast("int").alias("query_blocks"))
    spread = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    cand = vectors.join(sizes, "dim").filter("query_blocks > 0") \
        .withColumn("b", spread("blocks")) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    asked = queries.join(sizes, "dim").withColumn("qb", spread("query_blocks")) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cols, keys = ("vec_id", "v", "row"), ("dim", "b", "qb")
    found = cand.select(*cols, *keys).groupBy(*keys).cogroup(
        asked.select(*cols, *keys).groupBy(*keys)).applyInArrow(
        lambda left, right: _group(left, right, k),
        "query_row bigint, query_id bigint, row bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
