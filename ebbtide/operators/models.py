"""Distributed classifiers and the fitted preprocessing they share."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions import features
from ebbtide.operators import boosting
from ebbtide.operators.cleaning import fit_scaler, scaled_expressions
from ebbtide.operators.ranking import exact_median
from ebbtide.operators.sampling import with_weights
from ebbtide.schema import CUSTOMER, ID, NUMERIC, TARGET, quoted

_SEED = 42
TREES = ROUNDS = 200  # fixed values of the training run


# --- preprocessing ------------------------------------------------------------------------

# One reading of the raw columns for training and for scoring: numbers as numbers (total
# charges with the default when none is recorded) and the senior flag as text, whatever
# the type of the source.
_NUMBER = {  # the rule of ``bands.number``
    c: f"nanvl(CASE WHEN CAST({c} AS STRING) NOT RLIKE r'[0-9.][dDfF]\\s*$' THEN try_cast({c} AS DOUBLE) END, CAST(NULL AS DOUBLE))"
    for c in NUMERIC
}
_TYPED = (
    "SELECT * EXCEPT (tenure, MonthlyCharges, TotalCharges, SeniorCitizen), "
    f"{_NUMBER['tenure']} AS tenure, {_NUMBER['MonthlyCharges']} AS MonthlyCharges, "
    f"coalesce({_NUMBER['TotalCharges']}, {_NUMBER['MonthlyCharges']} * {_NUMBER['tenure']}) AS TotalCharges, "
    "CASE WHEN CAST(SeniorCitizen AS STRING) IN ('1', 'Yes') THEN 'Yes' "
    "WHEN CAST(SeniorCitizen AS STRING) IN ('0', 'No') THEN 'No' END AS SeniorCitizen FROM __THIS__"
)


def conform(df: DataFrame) -> DataFrame:
    """Add the customer columns a scoring input lacks: 0 for a number, null for text (no
    level applies)."""
    absent = [f for f in CUSTOMER.fields if f.name not in df.columns and f.name not in (ID, TARGET, "TotalCharges")]
    number = {f.name: not isinstance(f.dataType, T.StringType) for f in absent}
    added = {c: F.lit(0) if is_number else F.lit(None).cast("string") for c, is_number in number.items()}
    if "TotalCharges" not in df.columns:
        added["TotalCharges"] = F.lit(None).cast("string")
    return df.withColumns(added) if added else df


def _stage(columns: Mapping[str, str]) -> SQLTransformer:
    listed = ", ".join(f"{sql} AS {quoted(name)}" for name, sql in columns.items())
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")


def scaled_name(column: str) -> str:
    return f"scaled_{column}"


def fit_preprocessing(train: DataFrame) -> tuple[PipelineModel, dict[str, tuple[float, float]]]:
    """Typed columns, engineered features, encoding and scaling as one savable pipeline.

    The median charge and the scaler are measured on ``train`` and become constants of the
    pipeline. All stages but the last are SQL, so the whole chain is one generated loop.
    """
    median = exact_median(train, "MonthlyCharges")
    stages = [
        SQLTransformer(statement=_TYPED),
        _stage(features.engineered(median, senior_is_text=True)),
        _stage(features.dummies()),
    ]
    coded = PipelineModel(stages).transform(train)
    scaler = fit_scaler(coded)
    scaled = {scaled_name(c): sql for c, sql in scaled_expressions(scaler).items()}
    vector = VectorAssembler(inputCols=list(scaled), outputCol="features", handleInvalid="keep")
    return PipelineModel([*stages, _stage(scaled), vector]), scaler


# --- classifiers ------------------------------------------------------------------------------
# Parameter values are those of the training run; see README for the closest-match notes.


def fit_logistic(train: DataFrame) -> Model:
    """L2 logistic regression, inverse strength 0.1, balanced class weights."""
    weighted = with_weights(train, "balanced", target="label")
    rows = train.count()
    return LogisticRegression(
        maxIter=1000, regParam=1 / (0.1 * rows), elasticNetParam=0.0, standardization=False, weightCol="weight"
    ).fit(weighted)


def fit_random_forest(train: DataFrame, trees: int = TREES) -> Model:
    """200 trees of depth 12, at least two rows per leaf, balanced class weights."""
    return RandomForestClassifier(
        numTrees=trees,
        maxDepth=12,
        minInstancesPerNode=2,
        featureSubsetStrategy="sqrt",
        seed=_SEED,
        weightCol="weight",
    ).fit(with_weights(train, "balanced", target="label"))


#: Fixed values of the three boosters beside rounds and rate: growth, shares, penalties, least leaves.
WEIGHTED = boosting.Growth("level", depth=6, penalty=1.0, least_hessian=1.0, row_share=0.8, column_share=0.8)
LEAFWISE = boosting.Growth(
    "leaf", depth=10, leaves=31, penalty=0.0, least_hessian=1e-3, least_rows=20, row_share=0.8, column_share=0.8, from_average=True
)
SYMMETRIC = boosting.Growth("symmetric", depth=6, penalty=3.0)


def _own_booster(train: DataFrame, scheme: str, how: boosting.Growth, rounds: int) -> boosting.BoostedTrees:
    return boosting.fit_boosted(with_weights(train, scheme, target="label"), how, rounds, weight="weight", seed=_SEED)


def fit_gbt_weighted(train: DataFrame, rounds: int = ROUNDS) -> boosting.BoostedTrees:
    """Second-order boosting by levels: depth 6, 80 % of rows and columns per tree, positives
    weighted by negatives / positives."""
    return _own_booster(train, "scale_pos", WEIGHTED, rounds)


def fit_gbt_leafwise(train: DataFrame, rounds: int = ROUNDS) -> boosting.BoostedTrees:
    """Best leaf first up to 31 leaves and depth 10, 80 % of rows and columns, balanced weights."""
    return _own_booster(train, "balanced", LEAFWISE, rounds)


def fit_gbt_symmetric(train: DataFrame, rounds: int = ROUNDS) -> boosting.BoostedTrees:
    """One condition per level, depth 6, all rows and columns, positives weighted by all rows / positives."""
    return _own_booster(train, "total_pos", SYMMETRIC, rounds)


def fit_gbt(train: DataFrame, rounds: int = ROUNDS) -> Model:
    """Depth 5, 80 % of the rows per tree, no weights."""
    return GBTClassifier(maxIter=rounds, stepSize=0.1, maxDepth=5, subsamplingRate=0.8, featureSubsetStrategy="all", seed=_SEED).fit(train)


#: Anything that gives a probability of class 1.
Classifier = Model | boosting.BoostedTrees

FITTERS: dict[str, Callable[[DataFrame], Classifier]] = {
    "logistic": fit_logistic,
    "random_forest": fit_random_forest,
    "gbt_weighted": fit_gbt_weighted,
    "gbt_leafwise": fit_gbt_leafwise,
    "gbt_symmetric": fit_gbt_symmetric,
    "gbt": fit_gbt,
}
VOTERS = ("gbt_weighted", "gbt_leafwise", "gbt_symmetric", "gbt")  # fixed: members of the vote


def churn_probability(df: DataFrame, model: Classifier, column: str = "p") -> DataFrame:
    """Add the probability of class 1 and nothing else."""
    if isinstance(model, boosting.BoostedTrees):
        return model.score(df, column)
    own = model.copy()
    own.setProbabilityCol("_probability").setRawPredictionCol("").setPredictionCol("")
    scored = own.transform(df)
    return scored.withColumn(column, vector_to_array("_probability")[1]).drop("_probability")


def as_vectors(df: DataFrame) -> DataFrame:
    """Feature arrays to ML vectors."""
    if isinstance(df.schema["features"].dataType, VectorUDT):
        return df
    return df.withColumn("features", array_to_vector("features"))


def feature_importance(spark: SparkSession, model: Classifier) -> DataFrame | None:
    """(Feature, Importance), one row per model column; None when the model has none."""
    if isinstance(model, boosting.BoostedTrees):
        values = model.importances.tolist()
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray().tolist()
    else:
        return None
    return spark.createDataFrame(list(zip(features.MODEL_COLUMNS, values)), "Feature string, Importance double")


@dataclass(frozen=True)
class Segments:
    """Centroids in scaled units, numbered by rising tenure, and the scaler they use."""

    centroids: dict[int, tuple[float, ...]]
    scaler: dict[str, tuple[float, float]]
    columns: tuple[str, ...] = NUMERIC

    def centers(self) -> dict[int, tuple[float, ...]]:
        """Centroids in the units of the table."""
        return {
            number: tuple(c * self.scaler[n][1] + self.scaler[n][0] for c, n in zip(centre, self.columns))
            for number, centre in self.centroids.items()
        }


def fit_segments(train: DataFrame, k: int = 3, columns: tuple[str, ...] = NUMERIC) -> Segments:
    """k-means on the scaled numeric columns."""
    scaler = fit_scaler(train, columns)
    scaled = train.select([F.expr(sql).alias(c) for c, sql in scaled_expressions(scaler).items()])
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(scaled)
    model = KMeans(k=k, seed=_SEED).fit(vectors.select("features"))
    ordered = sorted(tuple(float(v) for v in centre) for centre in model.clusterCenters())
    return Segments(dict(enumerate(ordered)), scaler, columns)
