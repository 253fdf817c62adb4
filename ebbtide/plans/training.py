"""The training run: split, preprocess, balance, fit, compare, choose, save."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.operators import evaluation, models
from ebbtide.operators.sampling import fold_of, stratified_split
from ebbtide.operators.smote import balance
from ebbtide.schema import ID, TARGET
from ebbtide.session import materialise, shared_folder

MODELS = (*models.FITTERS, "vote")  # fixed: order of the candidates, first wins a tie
#: Folds that are prepared, and whose candidates are fitted, at once.
AT_ONCE = 3


@dataclass
class TrainingRun:
    """Everything fitted on one cleaned customer table. Parts are fitted when first used."""

    preprocessing: PipelineModel
    train: DataFrame  # key, features, label; written, not balanced
    test: DataFrame  # key, features, label; written
    balanced: DataFrame  # features, label; written
    fitted: dict[str, models.Classifier] = field(default_factory=dict)

    def model(self, name: str) -> models.Classifier:
        if name not in self.fitted:
            self.fitted[name] = models.FITTERS[name](self.balanced)
        return self.fitted[name]

    def fit_all(self, names: tuple[str, ...] = MODELS, at_once: int = 6) -> None:
        """Fit what is missing of ``names``, a few models at a time: their small stages overlap."""
        wanted = [m for m in models.FITTERS if m in names or ("vote" in names and m in models.VOTERS)]
        context = self.train.sparkSession.sparkContext

        def fit(name: str) -> None:
            # Under the fair scheduler every candidate has a pool of its own.
            context.setLocalProperty("spark.scheduler.pool", name)
            self.model(name)

        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(fit, wanted))

    def scores(self, names: tuple[str, ...], frame: DataFrame | None = None) -> DataFrame:
        """key, label and one column ``p_<model>`` each, in one pass over the rows."""
        wide = self.test if frame is None else frame
        for name in names:
            members = models.VOTERS if name == "vote" else (name,)
            for member in members:
                if f"p_{member}" not in wide.columns:
                    wide = models.churn_probability(wide, self.model(member), f"p_{member}")
            if name == "vote":
                total = sum((F.col(f"p_{m}") for m in models.VOTERS[1:]), F.col(f"p_{models.VOTERS[0]}"))
                wide = wide.withColumn("p_vote", total / len(models.VOTERS))
        return wide.select("row_key", F.col("label").cast("int").alias("y"), *[f"p_{n}" for n in names])

    def metrics(self, names: tuple[str, ...] = MODELS) -> DataFrame:
        """The six quality numbers on the test part, one row per model, in one job."""
        return candidate_metrics(self.scores(names), names)


def candidate_metrics(scores: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """The six quality numbers of the columns ``p_<model>``, one row per model, in one job."""
    entries = [
        F.struct(F.lit(MODELS.index(n)).alias("position"), F.lit(n).alias("model"), F.col(f"p_{n}").alias("p"))
        for n in names
    ]
    long = scores.select("y", F.explode(F.array(*entries)).alias("e")).select("y", "e.*")
    return evaluation.evaluate_model(long, by=("position", "model"))


def prepare(clean: DataFrame, method: str = "smote") -> TrainingRun:
    """Split a cleaned table, fit the preprocessing on the training part and balance it."""
    return _prepared(*stratified_split(clean), method)


def prepare_folds(clean: DataFrame, folds: int, method: str = "smote") -> list[TrainingRun]:
    """One run per fold of the training part of ``clean``: preprocessing, balancing and models
    know the other folds only, and its test part is the fold. Test rows are in none of them.

    Folds go by a hash of the key, so copies of a customer share one.
    """
    if folds < 2:
        raise ValueError("at least two folds")
    train = materialise(stratified_split(clean)[0].withColumn("_fold", fold_of(folds)))
    parts = [(train.where(F.col("_fold") != i).drop("_fold"), train.where(F.col("_fold") == i).drop("_fold")) for i in range(folds)]
    # Most stages of a fold are small and leave cores idle, so folds overlap.
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda part: _prepared(*part, method), parts))


def _prepared(train: DataFrame, test: DataFrame, method: str) -> TrainingRun:
    context = train.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        # Boosting cuts its lineage with checkpoints when a folder is known.
        context.setCheckpointDir(shared_folder(train.sparkSession))
    preprocessing, _ = models.fit_preprocessing(train)

    def encoded(part: DataFrame) -> DataFrame:
        return preprocessing.transform(part).select(
            F.col(ID).alias("row_key"), "features", F.col(TARGET).cast("double").alias("label")
        )

    train, test = materialise(encoded(train)), materialise(encoded(test))
    arrays = train.withColumn("features", vector_to_array("features"))
    balanced = materialise(models.as_vectors(balance(arrays, method)))
    return TrainingRun(preprocessing, train, test, balanced)


@dataclass(frozen=True)
class Selection:
    name: str
    metrics: DataFrame  # of every candidate, on the rows they were compared on
    thresholds: dict[str, float]
    test_metrics: DataFrame  # of the chosen one, on the test part


def out_of_fold_scores(folds: Sequence[TrainingRun], names: tuple[str, ...] = MODELS) -> DataFrame:
    """row_key, y and ``p_<model>`` of every training row, from models that did not see its fold."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda fold: fold.fit_all(names), folds))
    return materialise(reduce(DataFrame.unionByName, [fold.scores(names) for fold in folds]))


def select_out_of_fold(run: TrainingRun, folds: Sequence[TrainingRun], names: tuple[str, ...] = MODELS) -> Selection:
    """Choose the candidate and its thresholds on out-of-fold scores of the training part.

    The chosen one is then fitted on the whole training part; the test part is used for its
    reported quality alone.
    """
    scores = out_of_fold_scores(folds, names)
    metrics = materialise(candidate_metrics(scores, names))
    best = evaluation.select_best_model(metrics).first()["model"]
    thresholds = evaluation.best_thresholds(scores.select(F.col(f"p_{best}").alias("p"), "y"))
    run.fit_all((best,))
    return Selection(best, metrics, thresholds, materialise(run.metrics((best,))))


def train_and_select(run: TrainingRun, names: tuple[str, ...] = MODELS) -> Selection:
    """Fit the candidates, keep the best by F1 and find its two thresholds, all on the test part."""
    run.fit_all(names)
    metrics = materialise(run.metrics(names))
    best = evaluation.select_best_model(metrics).first()["model"]
    frame = run.scores((best,)).select(F.col(f"p_{best}").alias("p"), "y")
    return Selection(best, metrics, evaluation.best_thresholds(frame), metrics.where(F.col("model") == best))
