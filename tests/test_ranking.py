"""Distributed running totals, medians and exact cuts against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from ebbtide.operators import ranking, sampling
from ebbtide.session import materialise


@pytest.mark.parametrize("per_bucket", [3, 50, 10_000])
@pytest.mark.parametrize("descending", [True, False])
def test_running_totals(spark, per_bucket, descending):
    rng = random.Random(1)
    rows = [(g, round(rng.random(), 3), rng.randrange(9)) for g in ("a", "b") for _ in range(150)]
    rows = list({(g, k): (g, k, n) for g, k, n in rows}.values())
    counts = materialise(spark.createDataFrame(rows, "g string, k double, n bigint"))
    got = {
        (r["g"], r["k"]): (r["cum_n"], r["next_n"])
        for r in ranking.running_totals(counts, "k", ["n"], ["g"], descending, per_bucket).collect()
    }
    want = {}
    for g in ("a", "b"):
        ordered = sorted((k, n) for h, k, n in rows if h == g)
        ordered = ordered[::-1] if descending else ordered
        total = 0
        for i, (k, n) in enumerate(ordered):
            total += n
            want[g, k] = (total, ordered[i + 1][1] if i + 1 < len(ordered) else None)
    assert got == want


@pytest.mark.parametrize("n", [1, 2, 7, 100])
@pytest.mark.parametrize("per_bucket", [5, 10_000])
def test_exact_median(spark, n, per_bucket):
    values = [random.Random(n + i).choice([1.5, 2.0, 9.25, i / 3]) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    assert ranking.exact_median(df, "v", per_bucket) == statistics.median(values)


def test_median_of_nothing(spark):
    assert ranking.exact_median(spark.createDataFrame([(None,)], "v double"), "v") is None


@pytest.mark.parametrize("parts", [1, 7, 60])
def test_median_of_merged_sketches_has_the_right_rank(spark, parts):
    n = 60_001
    df = spark.range(n).select((F.col("id") * 7919 % n).cast("double").alias("v"), (F.col("id") % parts).alias("part"))
    stored = ranking.median_sketches(df, "v", ("part",))
    assert stored.agg(F.sum("n")).first()[0] == n
    assert abs(ranking.merged_median(stored) / n - 0.5) < 0.005


def test_median_sketch_without_values(spark):
    gaps = spark.createDataFrame([("a", None), ("b", float("nan")), ("b", 3.0)], "part string, v double")
    assert ranking.merged_median(ranking.median_sketches(gaps, "v", ("part",))) == 3.0
    assert ranking.merged_median(ranking.median_sketches(gaps.where("v is null"), "v", ("part",))) is None
    assert ranking.merged_median(ranking.median_sketches(gaps.where("v is null"), "v")) is None


@pytest.mark.parametrize("n", [0, 1, 250, 999, 1000, 1200])
def test_lowest_by_hash_takes_the_lowest(spark, n):
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"))
    keyed = [(r["h"], r["id"]) for r in df.select("id", ranking.seeded_digest("id").alias("h")).collect()]
    want = {i for _, i in sorted(keyed)[:n]}
    assert {r["id"] for r in ranking.lowest_by_hash(df, "id", n).collect()} == want


def test_lowest_by_hash_narrows_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(ranking, "_RANK_LIMIT", 0)
    df = spark.range(300).select(F.col("id").cast("string").alias("id"))
    keyed = [(r["h"], r["id"]) for r in df.select("id", ranking.seeded_digest("id").alias("h")).collect()]
    assert {r["id"] for r in ranking.lowest_by_hash(df, "id", 77).collect()} == {i for _, i in sorted(keyed)[:77]}


@pytest.mark.parametrize("n", [10, 300, 450, 599])
def test_lowest_by_hash_with_one_key_on_half_of_the_rows(spark, n):
    ids = ["hot"] * 300 + [f"c{i}" for i in range(300)]
    df = spark.createDataFrame([(i, j) for j, i in enumerate(ids)], "id string, j int").repartition(5)
    rows = ranking.lowest_by_hash(df, "id", n).collect()
    assert len(rows) == n and len({r["j"] for r in rows}) == n


@pytest.mark.parametrize("n", [0, 1, 13, 40])
def test_take_exact(spark, n):
    df = spark.range(40).repartition(7)
    assert ranking.take_exact(df, n).distinct().count() == n


def test_undersample_equals_out_and_repeats(spark):
    df = spark.createDataFrame([(f"c{i}", int(i % 5 == 0)) for i in range(200)], "customerID string, Churn int")
    first, again = (sampling.undersample(df).collect() for _ in range(2))
    assert sorted(first) == sorted(again)
    assert [sum(r["Churn"] == c for r in first) for c in (0, 1)] == [40, 40]


def test_split_is_complete_and_near_the_share(spark):
    df = spark.range(5000).select(F.concat(F.lit("c"), "id").alias("customerID"))
    train, test = sampling.stratified_split(df)
    assert train.count() + test.count() == 5000
    assert abs(test.count() / 5000 - 0.2) < 0.02
    assert test.join(train, "customerID").count() == 0


def test_exact_split_counts(spark):
    df = spark.createDataFrame([(f"c{i}", "Yes" if i < 33 else "No") for i in range(133)], "customerID string, Churn string")
    got = {r["Churn"]: r["count"] for r in sampling.stratified_test_exact(df).groupBy("Churn").count().collect()}
    assert got == {"Yes": 7, "No": 20}


def test_weights_of_a_single_class(spark):
    df = spark.createDataFrame([(0,), (0,)], "Churn int")
    rows = {r["scheme"]: (r["weight_0"], r["weight_1"]) for r in sampling.class_weights(df).collect()}
    assert rows == {"scale_pos": (1.0, 2.0), "total_pos": (1.0, 2.0), "balanced": (0.5, None)}


def test_exact_take_when_the_table_is_split_anew(spark):
    conf = {"spark.sql.files.openCostInBytes": "1", "spark.sql.leafNodeDefaultParallelism": "3"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        taken = ranking.take_exact(spark.range(0, 30_000, 1, 5).toDF("v"), 7_000)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "23")
        assert taken.count() == 7_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
