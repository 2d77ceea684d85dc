"""Boosted trees against a plain NumPy version that scans every split of every
leaf one at a time, with the same fixed-point gradients."""
import numpy as np
import pytest

from sessionkit.plans import boosting as B

UNIT = B.UNIT


def _table(spark, n=600, seed=0, parts=3):
    r = np.random.default_rng(seed)
    x = np.c_[r.normal(0, 1, n).round(1), r.integers(0, 5, n), r.exponential(1, n).round(2)]
    y = ((x[:, 0] + 0.6 * x[:, 1] - x[:, 2] + r.normal(0, 0.7, n)) > 0.8).astype(int)
    rows = [(i, *map(float, v), int(c), i % 3) for i, (v, c) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id bigint, a double, b double, c double, y int, fold int") \
        .repartition(parts)


def _slow_tree(bins, g, h, spec, bins_per):
    """List of nodes [feature, bin, left, value, gain], by plain recursion on rows."""
    def best(rows):
        G, H, top = g[rows].sum(), h[rows].sum(), None
        score = lambda a, b: (a / UNIT) ** 2 / (b / UNIT + spec.l2 + 1e-12)
        for f in range(len(bins)):
            for b in range(bins_per - 1):
                left = rows[bins[f, rows] <= b]
                GL, HL, NL = g[left].sum(), h[left].sum(), len(left)
                if min(HL, H - HL) < spec.least_hessian * UNIT or min(NL, len(rows) - NL) < max(1, spec.least_rows):
                    continue
                gain = score(GL, HL) + score(G - GL, H - HL) - score(G, H)
                if top is None or gain > top[0]:
                    top = (gain, f, b)
        return top if top and top[0] > B.LEAST_GAIN else None
    leaves = [(np.arange(bins.shape[1]), 0, best(np.arange(bins.shape[1])), [])]
    done, splits = [], []
    while leaves:
        can = [l for l in leaves if l[2] and (not spec.max_depth or l[1] < spec.max_depth)]
        if spec.max_leaves and len(leaves) + len(done) >= spec.max_leaves or not can:
            break
        top = max(can, key=lambda l: l[2][0]) if spec.max_leaves else can[0]
        leaves = [l for l in leaves if l is not top]
        rows, level, (gain, f, b), path = top
        splits.append((f, b, round(gain, 9), tuple(path)))
        for side, own in ((0, rows[bins[f, rows] <= b]), (1, rows[bins[f, rows] > b])):
            leaves.append((own, level + 1, best(own), [*path, side]))
    value = np.zeros(bins.shape[1])
    for rows, _, _, _ in leaves + done:
        value[rows] = -(g[rows].sum() / UNIT) / (h[rows].sum() / UNIT + spec.l2 + 1e-12)
    return sorted(splits, key=lambda s: s[3]), value


def _paths(tree):
    out, todo = [], [(0, ())]
    while todo:
        node, path = todo.pop()
        if tree.feature[node] >= 0:
            out.append((int(tree.feature[node]), int(tree.bin[node]), round(float(tree.gain[node]), 9), path))
            todo += [(int(tree.left[node]) + s, (*path, s)) for s in (0, 1)]
    return sorted(out, key=lambda s: s[3])


SPECS = [B.Spec(rounds=3, rate=0.3, max_depth=3, l2=1.0, least_hessian=1.0),
         B.Spec(rounds=3, rate=0.1, max_leaves=9, l2=0.0, least_hessian=1e-3, least_rows=20),
         B.Spec(rounds=2, rate=0.2, max_leaves=31, l2=0.0, least_hessian=1e-3, least_rows=5, weights=(1.0, 3.0), fold=1),
         B.Spec(rounds=2, rate=0.2, max_depth=9, fold=0)]


@pytest.fixture(scope="module")
def fitted(spark):
    x, y, df = _table(spark)
    edges = B.bin_edges(df, ["a", "b", "c"], 16)
    return x, y, df, edges, B.fit_many(df, ["a", "b", "c"], SPECS, "y", ["id"], edges)


@pytest.mark.parametrize("m", range(len(SPECS)))
def test_splits_and_values_equal_brute_force(fitted, m):
    x, y, _, edges, models = fitted
    spec, model = SPECS[m], models[m]
    seen = np.flatnonzero(np.arange(len(y)) % 3 != spec.fold) if spec.fold is not None else np.arange(len(y))
    bins = B._binned(list(x[seen].T), edges)
    margin = np.full(len(seen), model.base)
    for tree in model.trees:
        g, h = B.gradients(margin, y[seen], spec.weights)
        splits, value = _slow_tree(bins, g, h, spec, max(len(e) + 1 for e in edges))
        assert _paths(tree) == splits
        got = tree.value[B._leaf_of(bins, tree.feature, tree.bin, tree.left, tree.depth)]
        assert np.allclose(got, value, rtol=1e-12, atol=0)
        margin = margin + spec.rate * got
    assert len(model.trees) == spec.rounds


def test_leaf_wise_trees_hold_their_limit_at_unequal_depths(fitted):
    tree = fitted[4][2].trees[0]
    leaves = tree.feature < 0
    assert 2 < leaves.sum() <= 31
    level = {0: 0}
    for node in np.flatnonzero(~leaves):
        level[int(tree.left[node])] = level[int(tree.left[node]) + 1] = level[int(node)] + 1
    assert len({level[int(k)] for k in np.flatnonzero(leaves)}) > 1


def _alike(a, b):
    return len(a.trees) == len(b.trees) and all(
        (s.feature == t.feature).all() and (s.bin == t.bin).all() and (s.value == t.value).all()
        for s, t in zip(a.trees, b.trees))


def test_models_do_not_depend_on_partitions_company_or_rounds(spark, fitted, monkeypatch):
    _, _, df, edges, models = fitted
    monkeypatch.setattr(B, "TASK_ROWS", 100)     # six partitions, a job per level
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    monkeypatch.setattr(B, "PASS_BYTES", 4_000)  # leaves in several passes
    monkeypatch.setattr(B, "KEPT_LEAVES", 2)     # without subtraction
    sampled = B.Spec(rounds=4, rate=0.3, max_depth=4, row_share=0.7, feature_share=0.7)
    alone = [B.fit_many(df.repartition(5), ["a", "b", "c"], [s], "y", ["id"], edges)[0]
             for s in (SPECS[0], SPECS[2], sampled)]
    assert _alike(alone[0], models[0]) and _alike(alone[1], models[2])
    short = B.fit_many(df, ["a", "b", "c"], [B.replace(sampled, rounds=2)], "y", ["id"], edges)[0]
    assert _alike(alone[2].shortened(2), short)


def test_sums_over_partitions_do_not_reach_the_driver(spark, fitted, monkeypatch):
    _, _, df, edges, models = fitted
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    monkeypatch.setattr(B, "LEAST_ROWS", 100)

    def received(*_):
        raise AssertionError("sums of features x bins on the driver")
    monkeypatch.setattr(B.Growth, "receive", received)
    sampled = B.Spec(rounds=3, rate=0.3, max_depth=4, feature_share=0.7)
    for spec, want in ((SPECS[1], models[1]), (SPECS[3], models[3]), (sampled, None)):
        model, = B.fit_many(df, ["a", "b", "c"], [spec], "y", ["id"], edges)
        assert want is None or _alike(model, want)


def test_scores_saving_predictions_and_importances(spark, fitted):
    x, y, df, edges, _ = fitted
    spec, seen = B.Spec(rounds=4, rate=0.3, max_depth=3, fold=1), {}
    model, = B.fit_many(df, ["a", "b", "c"], [spec], "y", ["id"], edges, {0: {2, 4}},
                        lambda turn, counts: seen.update({turn: counts[0]}))
    for turn in (2, 4):
        out = model.shortened(turn).transform(df.filter("fold = 1")).select("y", "prediction").collect()
        assert seen[turn] == tuple(sum((r.y, r.prediction) == c for r in out)
                                   for c in ((0, 0), (0, 1), (1, 0), (1, 1)))
    from sessionkit.session import scratch_path
    path = scratch_path(spark, "t-boosted")
    model.save(spark, path)
    again = B.Boosted.load(spark, path)
    assert _alike(again, model) and again.spec == model.spec
    assert [t.depth for t in again.trees] == [t.depth for t in model.trees]
    gains = {}
    for t in model.trees:
        for f, g in zip(t.feature, t.gain):
            if f >= 0:
                gains.setdefault("abc"[f], []).append(g)
    rows = {r.Feature: r for r in B.importances(model.node_table(spark), ["a", "b", "c", "d"]).collect()}
    whole = sum(np.mean(v) for v in gains.values())
    for f in "abcd":
        v = gains.get(f, [])
        assert rows[f].splits == len(v) and abs(rows[f].total_gain - sum(v)) < 1e-9
        assert abs(rows[f].mean_gain - (np.mean(v) if v else 0)) < 1e-9
        assert abs(rows[f].Importance - (np.mean(v) / whole if v else 0)) < 1e-9


def test_missing_values_one_class_and_empty_tables(spark):
    nan = float("nan")
    rows = [(i, nan if i % 4 == 0 else None if i % 4 == 1 else float(i), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id bigint, a double, y int")
    spec = B.Spec(rounds=2, max_depth=2)
    model = B.fit(df, ["a"], spec, "y", ["id"])
    assert model.transform(df).count() == 40
    flat = B.fit(df.filter("y = 1"), ["a"], spec, "y", ["id"])
    assert all((t.feature < 0).all() for t in flat.trees)
    assert B.fit(df.limit(0), ["a"], spec, "y", ["id"]).trees == []


def test_rows_beyond_one_task_use_every_core(spark, monkeypatch):
    _, _, df = _table(spark)
    asked, real = [], B._blocks
    monkeypatch.setattr(B, "_blocks", lambda *a: asked.append(a[5]) or real(*a))
    spec, cores = B.Spec(rounds=1, max_depth=2), spark.sparkContext.defaultParallelism
    whole = B.fit(df, ["a", "b", "c"], spec, "y", ["id"])
    monkeypatch.setattr(B, "TASK_ROWS", 599)
    monkeypatch.setattr(B, "LEAST_ROWS", 10)
    parted = B.fit(df, ["a", "b", "c"], spec, "y", ["id"])
    assert asked == [1, max(2, cores)]
    assert np.array_equal(whole.trees[0].value, parted.trees[0].value)


def test_cells_of_a_task_follow_the_bins_of_each_feature():
    # a wide feature beside one of two bins: the sums of a leaf hold 200 + 2 cells, not 2 x 200
    r = np.random.default_rng(3)
    bins = np.stack([r.integers(0, 200, 900), r.integers(0, 2, 900)]).astype(np.uint8)
    y = (r.random(900) < 0.2 + 0.3 * bins[1] + 0.002 * bins[0]).astype(float)
    block = {"y": y, "fold": np.zeros(900, np.int8), "row": np.arange(900, dtype=np.uint64), "bins": bins,
             "margin": np.zeros((1, 900))}
    spec = B.Spec(rounds=1, max_depth=4)
    tree = B.Growth(spec, np.ones(2, dtype=bool), [200, 2])
    sums = B._Rows(block, 0, spec, 0).sums([0], tree)
    assert sums.shape == (3, 1, 202)
    g, h = B.gradients(block["margin"][0], y, spec.weights)
    for f, a, z in ((0, 0, 200), (1, 200, 202)):
        for own, weights in zip(sums[:, 0, a:z], (g, h, np.ones(900))):
            assert np.array_equal(own, np.bincount(bins[f], weights, z - a))
    grown = B._rounds_in_place([block], [spec], [200, 2], 0, 1)[0]["grown"][0][0]
    assert _paths(grown) == _slow_tree(bins, g, h, spec, 200)[0]


def test_leaves_of_few_rows_grow_in_tasks_without_a_pass_per_level(spark, fitted, monkeypatch):
    _, _, df, edges, models = fitted
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    monkeypatch.setattr(B, "MOST_ROWS", 200)
    passes, real = [], B.Growth.receive_cuts
    monkeypatch.setattr(B.Growth, "receive_cuts", lambda self, *a: passes.append(1) or real(self, *a))
    for m in (2, 3):
        passes.clear()
        model, = B.fit_many(df, ["a", "b", "c"], [SPECS[m]], "y", ["id"], edges)
        assert _alike(model, models[m])
        assert all((s.gain == t.gain).all() and (s.rows == t.rows).all() for s, t in zip(model.trees, models[m].trees))
        # 600 rows: few levels have a leaf of more than 150, whatever the depth
        assert len(passes) < sum(t.depth for t in models[m].trees)


@pytest.mark.parametrize("rows", [40, 3_000, 70_000, 300_000])
def test_features_counted_together_have_the_sums_of_each(rows):
    r = np.random.default_rng(rows)
    widths = [7, 200, 3, 5, 256, 2]
    bins = np.stack([r.integers(0, w, rows) for w in widths]).astype(np.uint8)
    g, h = r.integers(-2 ** 24, 2 ** 24, rows).astype(float), r.integers(1, 2 ** 22, rows).astype(float)
    cells, some = B._Cells(bins), np.flatnonzero(r.random(rows) < 0.9)
    for own, slot, n in ((None, None, 1), (some, None, 1), (some, r.integers(0, 3, len(some)), 3)):
        at = np.arange(rows) if own is None else own
        got = cells.sums(own, g[at], h[at], slot, n, widths)
        leaf = np.zeros(len(at), dtype=int) if slot is None else slot
        for f, (a, z) in enumerate(zip(np.cumsum([0, *widths]), np.cumsum(widths))):
            for x, weights in zip(got, (g[at], h[at], None)):
                want = np.bincount(leaf * widths[f] + bins[f, at], weights, n * widths[f]).reshape(n, -1)
                assert np.array_equal(x[:, a:z], want)


def test_superseded_checkpoints_are_deleted(spark, fitted, monkeypatch):
    import os
    _, _, df, edges, _ = fitted
    at = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    before = set(os.listdir(at))
    spec = B.Spec(rounds=12, max_depth=2)
    whole, = B.fit_many(df, ["a", "b", "c"], [spec], "y", ["id"], edges)
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    parted, = B.fit_many(df, ["a", "b", "c"], [spec], "y", ["id"], edges)
    assert _alike(whole, parted)
    assert {x for x in set(os.listdir(at)) - before if x.startswith("rdd-")} == set()
