"""Centroid clustering against plain Lloyd rounds on Python integers."""
import hashlib
import math
import random

import numpy as np
import pytest

from sessionkit.llm import centroids as C


def slow(rows, k, dim, rounds, seed="2", scale=256.0):
    far = (1 << 63) - 1

    def whole(x):
        y = float(x) * scale
        return far if y >= far else -far - 1 if y <= -far - 1 else math.floor(y)
    kept = [(i, [whole(x) for x in v]) for i, v in rows if v is not None and len(v) == dim
            and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, "" if r[0] is None else
                     hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centers = [list(v) for _, v in sorted(kept, key=key)[:k]]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    find = lambda v: min((away(v, c), i) for i, c in enumerate(centers))
    for _ in range(rounds):
        at = [find(v)[1] for _, v in kept]
        for c in range(len(centers)):
            own = [v for (_, v), a in zip(kept, at) if a == c]
            if own:
                centers[c] = [sum(x) // len(own) for x in zip(*own)]
    last = [find(v) for _, v in kept]
    own = [sum(d for d, a in last if a == c) for c in range(len(centers))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    cut = lambda x: min(x, far)
    return sorted(((i, a, cut(d), cut(sum(map(cut, [e for e, b in last if b == a]))),
                    cut(sum(cut(e) for e, _ in last)), sha[a])
                   for (i, _), (d, a) in zip(kept, last)), key=repr) if kept and own else []


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("spread", [0.01, 3.0])
def test_equals_plain_rounds_with_ties(spark, spread):
    r = random.Random(int(spread * 100))
    rows = [(i % 150, [round(r.gauss(0, spread), 2) for _ in range(3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    for k in (1, 7, 300):
        assert got(C.cluster(df, k=k, dim=3, rounds=3)) == slow(rows, k, 3, 3)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [nan, 1.0]), (5, [inf, 0.0]),
            (6, [None, 1.0]), (None, [5.0, 5.0]), (None, [-5.0, 4.0]), (7, []), (8, [1e300, -1e300]),
            (9, [4e9, -4e9]), (10, [0.001, -0.001])]
    df = spark.createDataFrame([(*x, "c", 1) for x in rows],
                               "vec_id bigint, embedding array<double>, cluster string, n int")
    for k in (2, 9):
        assert got(C.cluster(df, k=k, dim=2, rounds=2)) == slow(rows, k, 2, 2)
    assert got(C.cluster(df.limit(0), k=3, dim=2)) == []
    assert got(C.cluster(df.filter("vec_id = 2"), k=3, dim=2)) == []


def test_search_measures_fewer_than_all_on_clustered_vectors():
    r = np.random.default_rng(1)
    centers = r.integers(-10_000, 10_000, (40, 8))
    x = centers[r.integers(0, 40, 2000)] + r.integers(-20, 20, (2000, 8))
    found = C.Orchard(centers.tolist(), int(abs(x).max()))
    at, best, measured = found.nearest(x)
    full = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (best == full.min(axis=1)).all() and (at == full.argmin(axis=1)).all()
    assert measured < 0.5 * full.size
