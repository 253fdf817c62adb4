"""Splits, samples and class balancing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.operators.ranking import lowest_by_hash_per_group, seeded_digest
from ebbtide.schema import ID, TARGET

TEST_SIZE, SEED = 0.2, 42  # fixed values of the training run


def is_test(key: str = ID, test_size: float = TEST_SIZE, seed: int = SEED) -> Column:
    """Whether a row belongs to the test part: a hash of its key against a cut-off.

    No shuffle, no state, the same answer in every job. Copies of a customer stay on the
    same side, which also keeps them from leaking across the split.
    """
    cut = format(min(int(test_size * 2**32), 2**32 - 1), "08x")
    return F.substring(seeded_digest(key, seed), 1, 8) < F.lit(cut)


def fold_of(folds: int, key: str = ID, seed: int = SEED) -> Column:
    """Fold of a row, 0 to ``folds`` - 1, by other digits of the hash than the test part uses."""
    return (F.conv(F.substring(seeded_digest(key, seed), 9, 8), 16, 10).cast("long") % folds).cast("int")


def stratified_split(
    df: DataFrame, key: str = ID, test_size: float = TEST_SIZE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test). The hash is independent of the class, so every class is split in
    the same proportion up to random variation."""
    test = is_test(key, test_size, seed)
    return df.where(~test), df.where(test)


def class_counts(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.where(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def stratified_test_exact(
    df: DataFrame, key: str = ID, target: str = TARGET, test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """The test part with an exact count per class: the rows with the lowest key hash."""

    def shares(sizes: dict) -> dict:
        return {label: math.floor(n * test_size + 0.5) for label, n in sizes.items()}

    return lowest_by_hash_per_group(df, key, target, shares, seed)


def undersample(df: DataFrame, key: str = ID, target: str = TARGET, seed: int = SEED) -> DataFrame:
    """Every class cut to the size of the smallest one, rows chosen by key hash."""

    def smallest(sizes: dict) -> dict:
        return {label: min(sizes.values()) for label in sizes}

    return lowest_by_hash_per_group(df, key, target, smallest, seed)


def class_weights(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The weighting schemes of the classifiers, from one pass.

    ``scale_pos`` weighs a positive by negatives / positives, ``total_pos`` by all rows /
    positives, and ``balanced`` gives each class half of the total weight.
    """
    y = F.col(target)
    counts = df.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    n, pos, neg = F.col("pos") + F.col("neg"), F.col("pos"), F.col("neg")
    at_least_one = F.greatest(F.lit(1), pos)
    one = F.lit(1.0)
    lines = [
        ("scale_pos", one, neg / at_least_one),
        ("total_pos", one, n / at_least_one),
        ("balanced", F.try_divide(n, 2 * neg), F.try_divide(n, 2 * pos)),
    ]
    table = F.array(*[F.struct(F.lit(s).alias("scheme"), a.alias("weight_0"), b.alias("weight_1")) for s, a, b in lines])
    return counts.select(F.explode(table).alias("l")).select("l.*")


def with_weights(df: DataFrame, scheme: str, target: str = TARGET, column: str = "weight") -> DataFrame:
    """Rows unchanged, class weight added. The two weights are constants in the plan."""
    row = class_weights(df, target).where(F.col("scheme") == scheme).first()
    return df.withColumn(column, F.when(F.col(target) == 1, row["weight_1"]).otherwise(row["weight_0"]))


def preview(df: DataFrame, key: str = ID, n: int = 5, seed: int = SEED) -> DataFrame:
    """``n`` rows in a repeatable random order; a top-n, so nothing is fully sorted."""
    return df.orderBy(seeded_digest(key, seed), key).limit(n)


def explain_sample(df: DataFrame, key: str = ID, n: int = 50, seed: int = SEED) -> DataFrame:
    """Background rows for explanations."""
    return preview(df, key, n, seed)
