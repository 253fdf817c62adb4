"""Neighbour search against brute force, and what synthetic rows must satisfy."""

import numpy as np
import pytest

from ebbtide.operators.hashing import close_neighbours
from ebbtide.operators.neighbours import nearest_neighbours
from ebbtide.operators.smote import balance, oversample_smote
from ebbtide.session import materialise


def brute(x, k):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return {i: np.argsort(d[i], kind="stable")[:k].tolist() for i in range(len(x))}


@pytest.mark.parametrize("block", [25, 1000])
def test_neighbours_are_exact(spark, block):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(70, 3)), rng.normal(size=(50, 3)) + 6])
    points = materialise(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>"))
    found = {r["id"]: [h["id"] for h in r["hits"]] for r in nearest_neighbours(points, 5, block=block).collect()}
    assert found == brute(x, 5)


def test_fewer_points_than_neighbours(spark):
    points = materialise(spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [5.0])], "id bigint, x array<double>"))
    found = {r["id"]: [h["id"] for h in r["hits"]] for r in nearest_neighbours(points, 5).collect()}
    assert found == {0: [1, 2], 1: [0, 2], 2: [1, 0]}


def hits_of(table):
    return {r["id"]: [h["id"] for h in r["hits"]] for r in table.collect()}


def test_hash_tables_find_most_neighbours(spark):
    """Clusters of unequal density in 46 columns, most of them flags; buckets far below the table."""
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 40, 6000) * (rng.random(6000) < 0.7)  # one kind holds a third of the rows
    flags = (rng.random((40, 40)) < 0.4)[kinds] * 2.0
    x = np.hstack([flags, rng.normal(size=(6000, 6))])
    points = materialise(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>"))
    found, want = hits_of(close_neighbours(points, 5, bucket=400)), brute_rows(x, 5)
    assert all(len(set(h)) == len(h) == 5 and i not in h for i, h in found.items()) and len(found) == 6000
    recall = np.mean([len(set(found[i]) & set(want[i])) / 5 for i in want])
    print(f"recall {recall:.3f}")
    assert recall >= 0.9


def brute_rows(x, k):
    squares = (x * x).sum(1)
    out = {}
    for i in range(0, len(x), 500):
        d = squares[i : i + 500, None] + squares[None] - 2 * x[i : i + 500] @ x.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out.update({i + j: np.argsort(row, kind="stable")[:k].tolist() for j, row in enumerate(d)})
    return out


def test_few_points_are_searched_exactly(spark):
    x = np.random.default_rng(4).normal(size=(90, 3))
    points = materialise(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>"))
    assert hits_of(close_neighbours(points, 5)) == brute(x, 5)


def test_points_alike_in_every_projection(spark):
    """One direction only, so every bit is the same: buckets cannot be split, only cut."""
    points = materialise(spark.createDataFrame([(i, [1.0 + i * 1e-9]) for i in range(500)] + [(999, [-500.0])], "id bigint, x array<double>"))
    found = hits_of(close_neighbours(points, 5, bucket=50))
    assert all(len(h) >= 1 for i, h in found.items() if i != 999) and len(found) >= 500


def test_no_points(spark):
    none = materialise(spark.createDataFrame([], "id bigint, x array<double>"))
    assert close_neighbours(none, 5).collect() == []


def between(row, a, b):
    """Whether ``row`` lies on the segment from a to b."""
    span = b - a
    length = (span**2).sum()
    t = 0.0 if length == 0 else float(((row - a) * span).sum() / length)
    return -1e-9 <= t <= 1 + 1e-9 and np.allclose(a + t * span, row, atol=1e-9)


def test_synthetic_rows_lie_between_close_neighbours(spark):
    rng = np.random.default_rng(5)
    minority = rng.normal(size=(30, 2))
    rows = [(v.tolist(), 1.0) for v in minority] + [((v + 9).tolist(), 0.0) for v in rng.normal(size=(75, 2))]
    df = spark.createDataFrame(rows, "features array<double>, label double")
    out = [np.array(r["features"]) for r in oversample_smote(df).where("label = 1").collect()]
    assert len(out) == 75
    known = {tuple(v) for v in minority.tolist()}
    made = [v for v in out if tuple(v) not in known]
    assert len(made) == 45
    near = brute(minority, 5)
    for row in made:
        assert any(between(row, minority[i], minority[j]) for i in near for j in near[i])


def test_one_vector_on_most_rows(spark):
    rows = [([0.0, 0.0], 1.0)] * 50 + [([float(i), 1.0], 1.0) for i in range(10)] + [([9.0, 9.0], 0.0)] * 200
    df = spark.createDataFrame(rows, "features array<double>, label double")
    counts = {r["label"]: r["count"] for r in oversample_smote(df).groupBy("label").count().collect()}
    assert counts == {0.0: 200, 1.0: 200}


def test_repeats_from_run_to_run(spark):
    rows = [([float(i), float(i * i % 7)], 1.0) for i in range(12)] + [([0.5, 0.5], 0.0)] * 40
    df = spark.createDataFrame(rows, "features array<double>, label double").coalesce(1)
    one, two = (sorted(map(tuple, (r["features"] for r in oversample_smote(df).collect()))) for _ in range(2))
    assert one == two


@pytest.mark.parametrize("labels", [[1.0], [1.0, 0.0]])
def test_nothing_to_add(spark, labels):
    df = spark.createDataFrame([([1.0], y) for y in labels], "features array<double>, label double")
    assert oversample_smote(df).count() == len(labels)


@pytest.mark.parametrize("method, want", [("undersampling", 20), ("class_weight", 50), ("other", 50)])
def test_other_methods(spark, method, want):
    df = spark.createDataFrame([(f"c{i}", [float(i)], float(i < 10)) for i in range(50)], "row_key string, features array<double>, label double")
    assert balance(df, method).count() == want
