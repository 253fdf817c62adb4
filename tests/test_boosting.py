"""Boosted trees against brute force, and what must hold for every tree of each kind."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.operators import boosting, models
from ebbtide.session import materialise


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(400, 5)), 1)
    x[:, 3] = x[:, 3] > 0.4
    y = ((x[:, 0] + x[:, 1] * x[:, 3] + rng.normal(size=400) * 0.5) > 0.3).astype(float)
    w = np.where(y == 1, 2.0, 1.0)
    frame = spark.createDataFrame([(a.tolist(), b, c) for a, b, c in zip(x, y.tolist(), w.tolist())], "features array<double>, label double, weight double")
    return materialise(frame), x, y, w


def candidates(x, g, h, rows, how):
    """Every (gain, feature, value) by trying all values."""
    worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + how.penalty)
    out = {}
    for f in range(x.shape[1]):
        for v in np.unique(x[:, f])[:-1]:
            left = rows & (x[:, f] <= v)
            right = rows & ~left
            if min(left.sum(), right.sum()) >= max(how.least_rows, 1) and min(h[left].sum(), h[right].sum()) >= how.least_hessian:
                out[f, v] = worth(left) + worth(right) - worth(rows)
    return out


def brute(x, y, w, how):
    """First tree: {(path of conditions): value} grown one leaf (or level) at a time."""
    start = np.log((w * y).sum() / (w * (1 - y)).sum()) if how.from_average else 0.0
    p = 1 / (1 + np.exp(-start))
    g, h = w * (p - y), w * p * (1 - p) * np.ones(len(y))
    leaves = {(): np.ones(len(y), bool)}

    def split(path, f, v):
        rows = leaves.pop(path)
        leaves[(*path, (f, v, False))] = rows & (x[:, f] <= v)
        leaves[(*path, (f, v, True))] = rows & (x[:, f] > v)

    best = lambda found: max(found, key=lambda k: (round(found[k], 9), -k[0], -k[1])) if found else None
    if how.policy == "symmetric":
        for _ in range(how.depth):
            total = {}
            for rows in leaves.values():
                for k, v in candidates(x, g, h, rows, how).items():
                    total[k] = total.get(k, 0) + max(v, 0)
            for path in list(leaves):
                split(path, *best(total))
    else:
        while len(leaves) < how.leaves:
            open_ = {}
            for path, rows in leaves.items():
                found = candidates(x, g, h, rows, how) if len(path) < how.depth else {}
                if found and found[best(found)] > 0:
                    open_[path] = (found[best(found)], best(found))
            if not open_:
                break
            path = max(open_, key=lambda k: open_[k][0])
            split(path, *open_[path][1])
    return {k: -g[m].sum() / (h[m].sum() + how.penalty) * how.rate for k, m in leaves.items()}


def paths(tree):
    out, todo = {}, [(0, ())]
    while todo:
        n, path = todo.pop()
        if tree.feature[n] < 0:
            out[path] = tree.value[n]
        else:
            step = (int(tree.feature[n]), float(tree.cut[n]))
            todo += [(int(tree.left[n]), (*path, (*step, False))), (int(tree.right[n]), (*path, (*step, True)))]
    return out


@pytest.mark.parametrize("how", [
    boosting.Growth("leaf", depth=4, leaves=7, penalty=0.0, least_hessian=1e-3, least_rows=8, from_average=True),
    boosting.Growth("leaf", depth=10, leaves=31, penalty=0.5, least_rows=6),
    boosting.Growth("level", depth=3, penalty=1.0, least_hessian=1.0),
    boosting.Growth("symmetric", depth=3, penalty=3.0),
])
def test_first_tree_equals_brute_force(data, how):
    frame, x, y, w = data
    model = boosting.fit_boosted(frame, how, 1, weight="weight")
    got, want = paths(model.trees[0]), brute(x, y, w, how)
    # By value: two conditions may part the same rows. Symmetric trees also have empty leaves.
    one, two = (sorted(v for v in m.values() if abs(v) > 1e-12) for m in (got, want))
    assert len(one) == len(two) and np.allclose(one, two, atol=1e-9)
    assert len(got) > 4


@pytest.mark.parametrize("how", [models.WEIGHTED, models.LEAFWISE, models.SYMMETRIC])
def test_every_model(spark, data, how):
    frame, x, y, w = data
    model = boosting.fit_boosted(frame, how, 12, weight="weight")
    assert len(model.trees) == 12 and len(model.losses) == 13
    assert model.losses[-1] < model.losses[0] and all(b < a + 0.02 for a, b in zip(model.losses, model.losses[1:]))
    margin = model.margin(x)
    p = 1 / (1 + np.exp(-margin))
    assert model.losses[-1] == pytest.approx(-(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum())
    scored = model.score(frame).collect()
    assert np.allclose([r["p"] for r in scored], 1 / (1 + np.exp(-model.margin(np.array([r["features"] for r in scored])))), atol=1e-12)
    nodes = model.nodes(spark)
    leaves = nodes.where("feature < 0")
    wrong = leaves.where(F.abs(F.col("value") + how.rate * F.col("gradient") / (F.col("hessian") + how.penalty)) > 1e-12).where("rows > 0")
    assert wrong.count() == 0 and nodes.agg(F.max("depth")).first()[0] <= how.depth
    assert leaves.groupBy("tree").count().agg(F.max("count")).first()[0] <= min(how.leaves, 64)
    back = boosting.BoostedTrees.restore(nodes, model.state(spark))
    assert (back.margin(x) == margin).all() and back.losses == model.losses
    assert model.importances.sum() == pytest.approx(1) and len(model.importances) == 5


def test_symmetric_levels_have_one_condition(spark, data):
    model = boosting.fit_boosted(data[0], models.SYMMETRIC, 5)
    inner = model.nodes(spark).where("feature >= 0").groupBy("tree", "depth").agg(F.countDistinct("feature", "cut").alias("n"))
    assert inner.agg(F.max("n")).first()[0] == 1
    with pytest.raises(ValueError):
        boosting.fit_boosted(data[0], models.WEIGHTED, 1).expression("x")


@pytest.mark.parametrize("how", [models.WEIGHTED, models.SYMMETRIC])
def test_gaps_and_lone_classes(spark, data, how):
    nan = float("nan")
    rows = [([nan, 1.0], 1.0), ([2.0, nan], 0.0), (None, 1.0), ([1.0, 1.0], None), ([nan, 5.0], 1.0)] * 30
    frame = spark.createDataFrame(rows, "features array<double>, label double")
    model = boosting.fit_boosted(frame, how, 3)
    out = {str(r["features"]): r["p"] for r in model.score(frame).collect()}
    assert out["None"] is None and out["[nan, 1.0]"] > 0.5 > out["[2.0, nan]"]
    same = boosting.fit_boosted(frame.where("label = 1"), how, 2)
    assert all(t.feature[0] < 0 or len(t.feature) > 1 for t in same.trees)
    with pytest.raises(ValueError):
        boosting.fit_boosted(frame.where("label = 7"), how, 1)


def test_many_parts_are_added_in_groups(data, monkeypatch):
    frame, x, _, _ = data
    whole = boosting.fit_boosted(frame, models.WEIGHTED, 2)
    monkeypatch.setattr(boosting, "DRIVER_PARTS", 0)
    assert np.allclose(boosting.fit_boosted(frame, models.WEIGHTED, 2).margin(x), whole.margin(x))


def test_rows_of_one_task_are_fitted_in_one_job(spark, data):
    spark.sparkContext.setJobGroup("one-task", "")
    try:
        boosting.fit_boosted(data[0], models.LEAFWISE, 12, weight="weight")
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one-task")) < 12
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("added_by_driver", [0, 16])
def test_spread_rows_give_the_same_trees(data, monkeypatch, added_by_driver):
    frame, x, _, _ = data
    whole = boosting.fit_boosted(frame, models.SYMMETRIC, 5, weight="weight")
    for name, value in (("TASK_ROWS", 100), ("REWRITE", 2), ("DRIVER_PARTS", added_by_driver)):
        monkeypatch.setattr(boosting, name, value)
    spread = boosting.fit_boosted(frame, models.SYMMETRIC, 5, weight="weight")
    assert np.allclose(spread.losses, whole.losses) and np.allclose(spread.margin(x), whole.margin(x))
