"""Random forests against brute force, other paths and their own prefixes."""

from dataclasses import replace

import numpy as np
import pytest
from sessionkit.plans import forest as FO

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(1500, 4)), 1)
    x[::97, 1] = np.nan
    y = ((x[:, 0] + np.nan_to_num(x[:, 1]) + rng.normal(size=1500) * 0.7) > 0.3).astype(int)
    rows = [(f"k{i}", int(y[i]), i % 3, *map(float, x[i])) for i in range(1500)]
    df = spark.createDataFrame(rows, "key string, y int, fold int, a double, b double, c double, d double").persist()
    return df, FO.Rows(df, NAMES, "y", ["key"])


def _rows(rows):
    blocks = rows.blocks.collect()
    return {k: np.concatenate([b[k] for b in blocks], axis=-1) for k in ("y", "fold", "row", "bins")}


def _same(a, b):
    return len(a) == len(b) and all(
        np.array_equal(getattr(s, f), getattr(t, f)) for s, t in zip(a, b) for f in ("feature", "bin", "left", "value"))


def _plain(bins, y, count, tree, node, depth, size, spec, out):
    """One node after another, as nested tuples."""
    hits, total = count[y > 0].sum(), count.sum()
    gini = lambda h, t: 0.0 if not t else t - (h * h + (t - h) ** 2) / t
    best = (1e-9 * total, None)
    if 0 < hits < total and depth < spec.max_depth:
        for f in FO._tried(np.array([tree]), np.array([node]), len(bins), spec)[0]:
            for b in range(size):
                low = bins[f] <= b
                l, r = count[low].sum(), count[~low].sum()
                if min(l, r) < spec.least_rows:
                    continue
                gain = gini(hits, total) - gini(count[low & (y > 0)].sum(), l) \
                    - gini(count[~low & (y > 0)].sum(), r)
                if gain > best[0] + 1e-9:
                    best = gain, (int(f), b)
    if best[1] is None:
        return out.append((node, None, hits / total))
    f, b = best[1]
    out.append((node, best[1], hits / total))
    for side in (0, 1):
        own = (bins[f] > b) == bool(side)
        _plain(bins[:, own], y[own], count[own], tree, 2 * node + side, depth + 1, size, spec, out)


def test_trees_equal_plain_growth(table):
    _, rows = table
    spec = FO.Spec(trees=3, max_depth=7, least_rows=2, tried=2, fold=1)
    data = _rows(rows)
    use = data["fold"] != 1
    for i, tree in enumerate(FO.fit(rows, spec).trees):
        count = FO._bag(data["row"], spec, i) * use
        keep, want = count > 0, []
        _plain(data["bins"][:, keep], data["y"][keep], count[keep], i, 1, 0, rows.size, spec, want)
        ids, got = {0: 1}, []
        for k in range(len(tree.feature)):
            inner = tree.feature[k] >= 0
            if inner:
                ids[tree.left[k]], ids[tree.left[k] + 1] = 2 * ids[k], 2 * ids[k] + 1
            got.append((ids[k], (int(tree.feature[k]), int(tree.bin[k])) if inner else None, tree.value[k]))
        got, want = sorted(got, key=lambda n: n[0]), sorted(want, key=lambda n: n[0])
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_large_tables_grow_the_same_trees(table, monkeypatch):
    """Upper nodes by passes, subtrees in groups of nodes, few trees a shuffle."""
    _, rows = table
    for spec in (FO.Spec(trees=5, weights=(1.0, 2.5)), FO.Spec(trees=4, max_depth=3, fold=2, least_rows=4)):
        few = FO.fit(rows, spec).trees
        with monkeypatch.context() as m:
            m.setattr(FO, "TASK_ROWS", 100)
            m.setattr(FO, "GROUP_ROWS", 300)
            m.setattr(FO, "BATCH_ROWS", 3_000)
            many = FO.fit(rows, spec).trees
        assert _same(few, many) or all(
            np.array_equal(np.sort(s.value), np.sort(t.value)) for s, t in zip(few, many))
        bins = _rows(rows)["bins"]
        for s, t in zip(few, many):
            assert np.array_equal(s.value[FO._last(bins, s, s.depth)], t.value[FO._last(bins, t, t.depth)])


def test_smaller_forests_are_prefixes_and_score_alike(table):
    _, rows = table
    whole = FO.fit(rows, FO.Spec(trees=6, fold=0))
    sizes = {(2, 3), (6, 3), (6, 30), (4, 30)}
    counts = FO.scores(rows, whole, sizes)
    for trees, depth in sizes:
        small = FO.fit(rows, replace(whole.spec, trees=trees, max_depth=depth))
        assert FO.scores(rows, small, {(trees, depth)})[trees, depth] == counts[trees, depth]
        assert sum(counts[trees, depth]) == 500


def test_partitioning_does_not_matter_and_learns(spark, table):
    df, rows = table
    again = FO.Rows(df.repartition(7), NAMES, "y", ["key"], rows.edges)
    spec = FO.Spec(trees=8, least_rows=5)
    model = FO.fit(rows, spec)
    assert _same(model.trees, FO.fit(again, spec).trees)
    hit = model.transform(df).filter("prediction = y").count()
    assert hit > 1200


def test_pure_empty_and_constant_tables(spark):
    for rows in ([], [("a", 1, 1.0)], [("a", 1, 1.0), ("b", 0, 1.0)]):
        df = spark.createDataFrame(rows, "key string, y int, a double")
        model = FO.fit(FO.Rows(df, ["a"], "y", ["key"]), FO.Spec(trees=3, tried=1))
        assert model.transform(df).count() == len(rows)


def test_a_grid_of_sizes_is_one_fit_a_fold(spark, monkeypatch):
    from sessionkit.operators import sessions as S
    from sessionkit.plans import models as M, tuning as TU
    from sessionkit.sources.adapter import load_events
    data, fits, real = M.Prepared(S.build_model_ready(load_events(spark, "/root/testdata/sf0.001"))), [], FO.fit
    monkeypatch.setattr(FO, "fit", lambda rows, spec: fits.append(spec) or real(rows, spec))
    grid = {"n_estimators": [2, 4], "max_depth": [2, None], "min_samples_leaf": [1], "class_weight": ["balanced"]}
    res = TU.grid_search(data, "RandomForest", grid, refit=False)
    assert len(fits) == 3 and {s.fold for s in fits} == {0, 1, 2}
    for combo, score in res.scores:
        alone = []
        for fold in range(3):
            spec = M.forest_spec(combo, data.balanced, fold, len(data.scaled))
            size = spec.trees, spec.max_depth
            alone.append(TU.metric_of(FO.scores(data.binned(), real(data.binned(), spec), {size})[size], "f1"))
        assert abs(sum(alone) / 3 - score) < 1e-12


def test_rows_count_as_the_poisson_steps_say():
    from sessionkit.plans.boosting import _mixed
    rows, spec = np.random.default_rng(5).integers(0, 2 ** 63, 200_000).astype(np.uint64), FO.Spec(seed=7)
    want = np.searchsorted(FO._POISSON, _mixed(rows, 7 * 1_000_003 + 3), side="right")
    assert want.max() > 5 and np.array_equal(FO._bag(rows, spec, 3), want)


def test_tables_of_one_task_grow_whole_trees_without_passes(table, monkeypatch):
    _, rows = table
    monkeypatch.setattr(rows, "n", 1_000_000)
    monkeypatch.setattr(FO, "_fit_many", lambda *a: (_ for _ in ()).throw(AssertionError("passes")))
    assert len(FO.fit(rows, FO.Spec(trees=3, fold=0)).trees) == 3
