"""Extra trees and boosted trees against plain recursive versions."""

import datetime
import time
import tracemalloc

import numpy as np
import pytest

from crivo.operators import trees
from crivo.session import ship

DAY = datetime.date(2026, 1, 1)


def table(spark, n=160, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n).round(2), rng.integers(0, 6, n).astype(float), np.full(n, 3.0)])
    y = (x[:, 0] > 0.2) * 2.0 + x[:, 1] * 0.3 + rng.normal(size=n) * 0.1
    rows = [(f"t{i}", DAY, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id string, date date, f0 double, f1 double, f2 double, target double").repartition(3)


INPUTS = ["f0", "f1", "f2"]


def grown(x, y, tree, depth, min_leaf, seed):
    """One extra tree, node numbers as the operator gives them: pairs of children, level by level."""
    nodes, members, open_ = {0: None}, {0: np.arange(len(y))}, [0]
    count = 1
    for _ in range(depth):
        new, width = [], count
        for node in open_:
            rows = members[node]
            best = None
            for f in range(x.shape[1]):
                low, high = x[rows, f].min(), x[rows, f].max()
                if high > low:
                    at = low + trees.drawn(seed, tree, node, f) * (high - low)
                    a, b = rows[x[rows, f] <= at], rows[x[rows, f] > at]
                    if min(len(a), len(b)) >= min_leaf:
                        gain = y[a].sum() ** 2 / len(a) + y[b].sum() ** 2 / len(b)
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, f, at, a, b)
            if best:
                nodes[node] = (best[1], best[2], count)
                members[count], members[count + 1] = best[3], best[4]
                nodes[count] = nodes[count + 1] = None
                new += [count, count + 1]
                count += 2
        open_ = new
        if not new:
            break
        assert count >= width
    return nodes, members


def told(nodes, members, y, row):
    node = 0
    while nodes[node]:
        f, at, left = nodes[node]
        node = left if row[f] <= at else left + 1
    return y[members[node]].mean()


def test_extra_trees(spark):
    ship(spark)
    x, y, df = table(spark)
    many = 6
    model = trees.extra_trees(df, INPUTS, many, 4, 5, 42)
    want = np.zeros(len(y))
    # Children are numbered within the widest level of all trees, so draws are compared tree by tree where numbers agree.
    alone = [trees.extra_trees(df, INPUTS, 1, 4, 5, 42)]
    nodes, members = grown(x, y, 0, 4, 5, 42)
    want = np.array([told(nodes, members, y, r) for r in x])
    np.testing.assert_allclose(alone[0].predict(x, 4)[0], want, rtol=1e-9)
    found = model.predict(x, 4)
    assert found.shape == (many, len(y)) and len({tuple(t.round(6)) for t in found}) == many
    # every leaf holds the mean of its rows, and min_leaf of them at least
    for t, place in enumerate(model.places(x, 4)):
        for leaf in np.unique(place):
            inside = place == leaf
            assert inside.sum() >= 5
            np.testing.assert_allclose(model.value[t, leaf], y[inside].mean(), rtol=1e-9)
    mean = {r.id: r.predicted_return for r in trees.mean_of(model, df, INPUTS, 4).collect()}
    np.testing.assert_allclose([mean[f"t{i}"] for i in range(len(y))], found.mean(0), rtol=1e-9)


def plain_boost(bins, y, rounds, rate, leaves, depth, min_leaf):
    """Best-first boosting by trying every split."""
    predicted = np.full(len(y), y.mean())

    def best(rows):
        r, found = y - predicted, None
        for f in range(bins.shape[1]):
            for b in range(int(bins[:, f].max())):
                left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                if min(len(left), len(right)) >= min_leaf:
                    gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[rows].sum() ** 2 / len(rows)
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = (gain, left, right)
        return found

    for _ in range(rounds):
        groups = [(np.arange(len(y)), 0)]
        while len(groups) < leaves:
            tried = [(best(rows), i) for i, (rows, d) in enumerate(groups) if d < depth]
            tried = [(g, i) for g, i in tried if g]
            if not tried:
                break
            (_, left, right), i = max(tried, key=lambda t: t[0][0])
            d = groups.pop(i)[1]
            groups += [(left, d + 1), (right, d + 1)]
        step = np.zeros(len(y))
        for rows, _ in groups:
            step[rows] = rate * (y - predicted)[rows].mean()
        predicted = predicted + step
    return predicted


@pytest.mark.parametrize("leaves, depth, min_leaf", [(4, 2, 1), (7, 9, 3), (31, 3, 5), (2, 9, 1)])
def test_boosting_is_best_first(leaves, depth, min_leaf):
    rng = np.random.default_rng(leaves)
    bins = rng.integers(0, 7, (90, 3)).astype(np.uint8)
    y = (bins[:, 0] > 2) * 1.5 + bins[:, 1] * 0.2 + rng.normal(size=90) * 0.3
    setting = trees.Boosting(5, 0.3, leaves, depth, min_leaf)
    keys = np.arange(90, dtype=np.uint64)
    base, grown_ = trees.in_step({"a": trees.boost(bins, y, keys, 8, setting)}, lambda a: a)["a"]
    edges = [np.arange(7, dtype=float)] * 3
    model = trees._packed(grown_, edges)
    found = base + model.predict(bins.astype(float), min(depth, leaves)).sum(0)
    np.testing.assert_allclose(found, plain_boost(bins, y, 5, 0.3, leaves, depth, min_leaf), rtol=1e-9)


def test_partitions_change_nothing():
    """Two parts in step, with shares of rows and features, give what one part gives."""
    rng = np.random.default_rng(5)
    bins, keys = rng.integers(0, 20, (200, 4)).astype(np.uint8), rng.integers(0, 2**62, 200).astype(np.uint64)
    y = bins[:, 0] * 0.1 + rng.normal(size=200)
    setting = trees.Boosting(6, 0.1, 9, 5, 2, 0.7, 0.6)
    whole = trees.in_step({"a": trees.boost(bins, y, keys, 20, setting)}, lambda a: a)["a"]
    cut = [slice(0, 70), slice(70, 70), slice(70, 200)]
    runs = [trees.boost(bins[c], y[c], keys[c], 20, setting) for c in cut]
    asked, ends = [next(r) for r in runs], []
    while not ends:
        total, asked = np.sum(asked, axis=0), []
        for r in runs:
            try:
                asked.append(r.send(total))
            except StopIteration as end:
                ends.append(end.value)
    assert len(ends) == 3
    for base, grown_ in ends:
        assert base == pytest.approx(whole[0])
        for a, b in zip(grown_, whole[1]):
            assert [list(c) for c in a[:3]] == [list(c) for c in b[:3]]
            np.testing.assert_allclose(a[3], b[3], rtol=1e-9)


def test_tasks_exchange_histograms(spark, monkeypatch):
    ship(spark)
    x, y, df = table(spark, 60)
    settings = {"a": trees.Boosting(1, 0.5, 3, 2), "b": trees.Boosting(1, 0.5, 4, 2, 5)}
    one = trees.boosted(df, INPUTS, settings)
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 25)
    three = trees.boosted(df, INPUTS, settings)
    for name in settings:
        np.testing.assert_allclose(one[name][1].predict(x, 2), three[name][1].predict(x, 2), rtol=1e-9)
        got = {r.id: r.predicted_return for r in trees.sum_of(*three[name], df, INPUTS, 2).collect()}
        np.testing.assert_allclose([got[f"t{i}"] for i in range(60)], one[name][0] + one[name][1].predict(x, 2).sum(0), rtol=1e-9)


def test_exchanges_do_not_wait_for_the_barrier(spark, monkeypatch):
    """Some 60 exchanges, each of which took a second; where only Spark can open the folder, the barrier carries them."""
    ship(spark)
    x, y, df = table(spark, 60)
    settings = {"a": trees.Boosting(20, 0.5, 4, 3)}
    one = trees.boosted(df, INPUTS, settings)
    monkeypatch.setattr(trees, "ROWS_PER_TASK", 25)
    began = time.time()
    three = trees.boosted(df, INPUTS, settings)
    assert time.time() - began < 25
    np.testing.assert_allclose(one["a"][1].predict(x, 3), three["a"][1].predict(x, 3), rtol=1e-9)
    monkeypatch.setattr(trees, "checkpoint_folder", lambda spark: "viewfs:///nowhere")
    few = {"a": trees.Boosting(1, 0.5, 4, 2)}
    barrier = trees.boosted(df, INPUTS, few)
    np.testing.assert_allclose(one["a"][1].predict(x, 2)[0], barrier["a"][1].predict(x, 2)[0], rtol=1e-9)


@pytest.mark.parametrize("ranges", [True, False])
def test_blocks_of_a_level(monkeypatch, ranges):
    """Ranges and sums of every open node, over blocks of any size, are those of its rows one by one."""
    rng = np.random.default_rng(3)
    n, many, width = 9_000, 12, 15
    x, y = np.column_stack([rng.normal(size=n).round(1), rng.integers(0, 9, n).astype(float)]), rng.normal(size=n)
    feature, left = np.full((many, width), -1), np.full((many, width), -1)
    feature[:, :7], left[:, :7] = rng.integers(0, 2, (many, 7)), 2 * np.arange(7) + 1
    feature[0, 2] = feature[0, 5] = feature[0, 6] = -1  # a leaf two levels above the others
    threshold = np.where(feature == 0, rng.normal(size=(many, width)), rng.integers(1, 8, (many, width)))
    open_ = np.zeros((many, width), bool)
    open_[:, 7:] = True
    open_[0, 11:] = open_[1, 8] = False
    model = trees.Trees(feature, threshold, left, np.zeros((many, width)))
    level = trees.Level(model, 3, open_, np.stack([rng.normal(size=(many, width)).round(1), rng.integers(0, 9, (many, width))], 2))
    batches = [
        trees.pa.RecordBatch.from_arrays([trees.pa.array(c[a : a + 700]) for c in (*x.T, y)], names=["f0", "f1", "target"])
        for a in range(0, n, 700)
    ]
    for size in (65_535, 1_000, 333):
        monkeypatch.setattr(trees, "BLOCK_ROWS", size)
        (out,) = trees._partial(level, ["f0", "f1"], ranges)(iter(batches))
        got = {tuple(r[c] for c in ("tree", "node", "feature")): (r["a"], r["b"]) for r in out.to_pylist()}
        want = {}
        for t, place in enumerate(model.places(x, 3)):
            for node in np.flatnonzero(open_[t]):
                inside = place == node
                for f in range(2):
                    v, at = x[inside, f], level.threshold[t, node, f]
                    if ranges and len(v):
                        want[t, node, f] = (v.min(), v.max())
                    elif not ranges and (v <= at).any():
                        want[t, node, f] = ((v <= at).sum(), y[inside][v <= at].sum())
        assert got.keys() == want.keys()
        np.testing.assert_allclose([got[k] for k in want], list(want.values()), rtol=1e-9, atol=1e-9)


def test_a_level_costs_less_than_walking():
    """What a task does for a level, all sums included, takes less than its rows' walk from the root did alone."""
    rng = np.random.default_rng(4)
    n, many, depth = 60_000, 16, 6
    width, inner = 2 ** (depth + 1) - 1, 2**depth - 1
    x, y = rng.normal(size=(n, 6)), rng.normal(size=n)
    feature, left = np.full((many, width), -1), np.full((many, width), -1)
    feature[:, :inner], left[:, :inner] = rng.integers(0, 6, (many, inner)), 2 * np.arange(inner) + 1
    open_ = np.broadcast_to(np.arange(width) >= inner, (many, width))
    model = trees.Trees(feature, rng.normal(size=(many, width)), left, np.zeros((many, width)))
    level = trees.Level(model, depth, open_, rng.normal(size=(many, width, 6)))
    names = [f"f{i}" for i in range(6)]
    batch = trees.pa.RecordBatch.from_arrays([trees.pa.array(c) for c in (*x.T, y)], names=[*names, "target"])

    def best(work):
        took = []
        for _ in range(3):
            began = time.perf_counter()
            work()
            took.append(time.perf_counter() - began)
        return min(took)

    walk = best(lambda: model.places(x, depth))
    for ranges in (True, False):
        assert best(lambda: list(trees._partial(level, names, ranges)(iter([batch])))) < walk


def plain_forest_tree(bins, y, times, depth, min_leaf):
    """One tree by trying every split, with rows counted as often as its sample has them; each row's value."""
    out = np.zeros(len(y))

    def grow(rows, left):
        w = times[rows]
        found, whole = None, (w * y[rows]).sum() ** 2 / w.sum()
        for f in range(bins.shape[1]) if left else ():
            for b in range(int(bins[:, f].max())):
                side = bins[rows, f] <= b
                n, m = w[side].sum(), w[~side].sum()
                if min(n, m) >= min_leaf:
                    gain = (w * y[rows])[side].sum() ** 2 / n + (w * y[rows])[~side].sum() ** 2 / m - whole
                    if gain > 1e-12 and (found is None or gain > found[0] + 1e-12):
                        found = (gain, rows[side], rows[~side])
        if found:
            grow(found[1], left - 1)
            grow(found[2], left - 1)
        else:
            out[rows] = (w * y[rows]).sum() / w.sum()

    grow(np.arange(len(y)), depth)
    return out


def test_forest_is_that_of_all_splits(spark):
    ship(spark)
    x, y, df = table(spark)
    keys = {r.id: r.k for r in df.selectExpr("id", "xxhash64(id, date) as k").collect()}
    keys = np.array([keys[f"t{i}"] for i in range(len(y))]).view(np.uint64)
    edges = trees.bin_edges(df, INPUTS, 8)
    bins = np.column_stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)])
    model = trees.random_forest(df, INPUTS, 5, 4, 3, 42, 8)
    found = model.predict(x, 4)
    for tree in range(5):
        want = plain_forest_tree(bins, y, trees.bagged(keys, tree, 42).astype(float), 4, 3)
        np.testing.assert_allclose(found[tree], want, rtol=1e-9)
    assert len({tuple(t.round(9)) for t in found}) == 5
    again = trees.random_forest(df.repartition(7), INPUTS, 5, 4, 3, 42, 8)
    np.testing.assert_allclose(again.predict(x, 4), found, rtol=1e-9)


def test_samples_are_drawn_with_replacement():
    keys = np.random.default_rng(1).integers(0, 2**62, 200_000).astype(np.uint64)
    one, other = (trees.bagged(keys, t, 42) for t in (0, 1))
    share = np.bincount(one, minlength=4)[:4] / len(keys)
    np.testing.assert_allclose(share, np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.005)
    assert abs(np.corrcoef(one, other)[0, 1]) < 0.01 and (one == trees.bagged(keys, 0, 42)).all()


def test_boosting_holds_lists_of_rows_not_of_cells():
    """Beside the bins themselves, a task holds some numbers a row, not eight bytes and more for every (row, feature)."""
    rng = np.random.default_rng(6)
    n, width = 50_000, 40
    bins, keys = rng.integers(0, 64, (n, width)).astype(np.uint8), rng.integers(0, 2**62, n).astype(np.uint64)
    y = bins[:, 0] + rng.normal(size=n)
    tracemalloc.start()
    trees.in_step({"a": trees.boost(bins, y, keys, 64, trees.Boosting(1, 0.3, 8, 4, rows=0.9))}, lambda a: a)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * n * width
