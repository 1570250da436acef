"""The five classifiers as Spark ML pipelines, each with its own preprocessing."""

from __future__ import annotations

import logging
import math
import statistics
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.param import Param
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from flowlab.functions.columns import col
from flowlab.functions.small import local_rows
from flowlab.operators.bayes import GaussianBayes
from flowlab.operators.boosting import JointBoosting
from flowlab.operators.prepare import class_weights
from flowlab.operators.sampling import stratified_split

WEIGHT = "class_weight"
PARALLELISM = 8
PATIENCE = 20  # fixed value: rounds without a lower loss before boosting ends
FOREST_BYTES = 1 << 28  # of rows that a task of a forest holds, about


@dataclass(frozen=True)
class Preset:
    """Settings of one classifier. `key` names its columns and its saved model."""

    key: str
    title: str
    family: str
    params: dict = field(default_factory=dict)
    scaled: bool = False
    balanced: bool = False

    def with_params(self, **changes) -> "Preset":
        return replace(self, params={**self.params, **changes})


# The settings that the published figures were made with.
LOGISTIC = Preset("logistic_regression", "Logistic Regression", "logistic",
                  {"c": 10.0, "iterations": 1000}, scaled=True, balanced=True)
BAYES = Preset("naive_bayes", "Naive Bayes", "bayes", {"smoothing": 1e-5}, scaled=True)
FOREST = Preset("random_forest", "Random Forest", "forest",
                {"trees": 50, "depth": 5, "leaf": 20, "features": "sqrt"}, balanced=True)
BOOSTING_REGULARISED = Preset(
    "boosting_regularised", "Gradient Boosting (regularised)", "boosting",
    {"rounds": 100, "depth": 3, "rate": 0.01, "rows": 0.5, "columns": 0.5, "leaf": 1,
     "leaf_weight": 10.0, "l1": 1.0, "l2": 10.0, "gamma": 5.0, "bins": 256})
BOOSTING_REGULARISED_FALLBACK = Preset(
    "boosting_regularised", "Gradient Boosting (regularised) [fallback]", "boosting",
    {"rounds": 100, "depth": 7, "rate": 0.1, "rows": 0.8, "columns": 0.8, "leaf": 1,
     "leaf_weight": 1.0, "l1": 0.0, "l2": 1.0, "gamma": 0.0, "bins": 256})
BOOSTING_BALANCED = Preset(
    "boosting_balanced", "Gradient Boosting (balanced)", "boosting",
    {"rounds": 100, "depth": 7, "rate": 0.05, "rows": 0.8, "columns": 0.8, "leaf": 100,
     "leaf_weight": 0.001, "l1": 0.0, "l2": 10.0, "gamma": 0.0, "bins": 255}, balanced=True)
BOOSTING_BALANCED_FALLBACK = Preset(
    "boosting_balanced", "Gradient Boosting (balanced) [fallback]", "boosting",
    {"rounds": 100, "depth": 7, "rate": 0.1, "rows": 0.8, "columns": 0.8, "leaf": 5,
     "leaf_weight": 0.001, "l1": 0.0, "l2": 0.0, "gamma": 0.0, "bins": 255})

PRESETS = (LOGISTIC, BAYES, FOREST, BOOSTING_REGULARISED, BOOSTING_BALANCED)
FALLBACKS = {
    BOOSTING_REGULARISED.key: BOOSTING_REGULARISED_FALLBACK,
    BOOSTING_BALANCED.key: BOOSTING_BALANCED_FALLBACK,
}


def _boosting(preset: Preset, seed: int, parallelism: int, **more) -> JointBoosting:
    p = preset.params
    return JointBoosting(
        rounds=p["rounds"], depth=p["depth"], rate=p["rate"], rows=p["rows"], columns=p["columns"],
        leafRows=p["leaf"], leafWeight=p["leaf_weight"], l1=p["l1"], l2=p["l2"], gamma=p["gamma"],
        bins=p["bins"], seed=seed, parallelism=parallelism, **more)


def _classifier(preset: Preset, rows: int, label: str, seed: int, parallelism: int) -> Estimator:
    k, p = preset.key, preset.params
    inputs = f"{k}_scaled" if preset.scaled else f"{k}_features"
    names = {"featuresCol": inputs, "labelCol": label, "predictionCol": f"{k}_prediction"}
    weight = {"weightCol": WEIGHT} if preset.balanced else {}
    if preset.family == "bayes":
        return GaussianBayes(**names, probabilityCol=f"{k}_probability", smoothing=p["smoothing"])
    names |= {"rawPredictionCol": f"{k}_raw", "probabilityCol": f"{k}_probability"}
    if preset.family == "boosting":
        return _boosting(preset, seed, parallelism, **names, **weight)
    if preset.family == "logistic":
        # The penalty is per row, and Spark scales by the sample deviation, not the
        # population one: (rows - 1) / rows makes up for that.
        strength = (rows - 1) / (p["c"] * rows * rows) if rows > 1 else 0.0
        return LogisticRegression(**names, **weight, family="multinomial", regParam=strength,
                                  elasticNetParam=0.0, maxIter=p["iterations"],
                                  standardization=False)
    return RandomForestClassifier(
        **names, **weight, numTrees=p["trees"], maxDepth=p["depth"],
        minInstancesPerNode=p["leaf"], featureSubsetStrategy=p["features"], seed=seed)


def pipeline(preset: Preset, features: Sequence[str], label: str, rows: int, seed: int = 42,
             parallelism: int = PARALLELISM) -> Pipeline:
    """Assemble, scale where the model wants it, classify."""
    k = preset.key
    stages: list = [VectorAssembler(inputCols=list(features), outputCol=f"{k}_features")]
    if preset.scaled:
        stages.append(StandardScaler(inputCol=f"{k}_features", outputCol=f"{k}_scaled",
                                     withMean=True, withStd=True))
    stages.append(_classifier(preset, rows, label, seed, parallelism))
    return Pipeline(stages=stages)


def _training(preset: Preset, train: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    narrow = train.select(*[col(f) for f in features], col(label).cast("double").alias(label))
    return class_weights(narrow, label, WEIGHT) if preset.balanced else narrow


def _dealt(training: DataFrame, rows: int, width: int, trees: int) -> DataFrame:
    """The rows in more partitions, where few hold too many: a forest's tasks keep every row's bins,
    and how often each tree draws it, in memory."""
    tasks = -(-rows * (4 * width + 4 * trees + 128) // FOREST_BYTES)
    return training.repartition(tasks) if training.rdd.getNumPartitions() < tasks else training


def fit_model(
    preset: Preset, train: DataFrame, features: Sequence[str], label: str = "label",
    seed: int = 42, parallelism: int = PARALLELISM,
) -> PipelineModel:
    """Train one classifier on labels 0..k-1."""
    if preset.family == "forest":
        # Spark's forest reads its rows several times before it holds them: what they are computed from
        # is read once.
        kept = train.select(*[col(c) for c in dict.fromkeys([*features, label])]).persist(StorageLevel.DISK_ONLY)
        try:
            rows = kept.count()
            training = _dealt(_training(preset, kept, features, label), rows, len(features), preset.params["trees"])
            return pipeline(preset, features, label, rows, seed, parallelism).fit(training)
        finally:
            kept.unpersist()
    rows = train.count() if preset.family == "logistic" else 0
    training = _training(preset, train, features, label)
    return pipeline(preset, features, label, rows, seed, parallelism).fit(training)


def fit_with_fallback(
    presets: Sequence[Preset], fit: Callable[[Preset], object],
) -> tuple[Preset, object, list[str]]:
    """The first of the presets that trains, what it gave, and the errors of those before
    it; the last one's error is raised."""
    errors: list[str] = []
    for at, preset in enumerate(presets):
        try:
            return preset, fit(preset), errors
        except Exception as error:
            if at == len(presets) - 1:
                raise
            errors.append(f"{preset.title}: {type(error).__name__}: {error}")
            logging.getLogger(__name__).warning("%s", errors[-1])
    raise ValueError("no preset given")


def fit_early_stopping(
    preset: Preset, train: DataFrame, features: Sequence[str], label: str = "label",
    fraction: float = 0.1, patience: int = PATIENCE, key_cols: Sequence[str] | None = None,
    seed: int = 42, parallelism: int = PARALLELISM, watched: DataFrame | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Boosting that ends `patience` rounds after the lowest loss on watched rows, and keeps the
    rounds up to it. The watched rows are `watched`, or a stratified slice of the training rows.

    Also returns the loss of each round trained, and whether the round is kept."""
    if watched is None:
        rows = stratified_split(train, label, fraction, key_cols, seed, out="_watched")
    else:
        needed = [*features, label]
        rows = (train.select(*map(col, needed)).withColumn("_watched", F.lit(False))
                .unionByName(watched.select(*map(col, needed)).withColumn("_watched", F.lit(True))))
    training = rows.select(*[col(f) for f in features], col(label).cast("double").alias(label), "_watched")
    if preset.balanced:
        training = class_weights(training, label, WEIGHT)
    assembler, booster = pipeline(preset, features, label, 0, seed, parallelism).getStages()
    booster._set(validationIndicatorCol="_watched", patience=patience)
    model = booster.fit(assembler.transform(training))
    return PipelineModel(stages=[assembler, model]), model.rounds_table(train.sparkSession)


def feature_importance(
    model: PipelineModel, features: Sequence[str], spark, top: int = 15,
) -> DataFrame:
    """The most important features of a tree model."""
    sums = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    order = sorted(range(len(features)), key=lambda i: (-sums[i], features[i]))[:top]
    return local_rows(spark, [(r + 1, features[i], sums[i]) for r, i in enumerate(order)],
                      "rank int, feature string, importance double")


# The settings of the search, 27 in all.
GRID = {"rate": (0.01, 0.05, 0.1), "depth": (5, 7, 10), "l2": (0.5, 1.0, 2.0)}


def boosting_grid(booster: JointBoosting, **values: Sequence) -> list[dict]:
    """All combinations of step size, depth and L2 term, the first varying slowest."""
    grid = ParamGridBuilder()
    for name, default in GRID.items():
        grid.addGrid(booster.getParam(name), list(values.get(name, default)))
    return grid.build()


def settings(entry: dict) -> str:
    return ", ".join(f"{param.name}={value}" for param, value in entry.items())


def _fold_scores(
    estimator: Estimator, entry: dict, folded: DataFrame, label: str, prediction: str, fold: str,
    folds: int, judge: MulticlassClassificationEvaluator,
) -> list[float]:
    """The metric on each fold of a model fitted on the others."""
    out = []
    for i in range(folds):
        model = estimator.fit(folded.where(F.col(fold) != i), entry)
        out.append(judge.evaluate(model.transform(folded.where(F.col(fold) == i))))
    return out


def grid_search(
    estimator: Estimator, grid: list[dict], folded: DataFrame, label: str, prediction: str,
    fold: str = "fold", metric: str = "accuracy", parallelism: int = 2,
    halving: tuple[Param, int] | None = None, factor: int = 3,
) -> tuple[object, DataFrame]:
    """Best model by mean cross-validated metric over given folds, and all means.

    Every setting is tried in full. With `halving`, a setting and its full value (boosting's
    rounds, say), all are tried with a small value of it, and the best of them, 1 in `factor`,
    again with `factor` times as much, until the full value is reached: `tried` has the value
    that each got last. The trials run side by side, `parallelism` of them, over the same rows,
    which should be assembled and kept by the caller; only the best is fitted on all folds."""
    folds = folded.agg(F.max(fold)).head()[0] + 1
    judge = MulticlassClassificationEvaluator(
        labelCol=label, predictionCol=prediction, metricName=metric)
    known: dict[int, tuple[int | None, list[float]]] = {}
    if halving is None:
        rungs: list[int | None] = [None]
    else:
        resource, full = halving
        steps = max(1, math.ceil(math.log(max(len(grid), 1), factor)))
        rungs = sorted({max(1, full // factor ** i) for i in range(steps)})
    left = list(range(len(grid)))
    for n, rung in enumerate(rungs):
        def trial(i: int) -> list[float]:
            entry = dict(grid[i]) if rung is None else {**grid[i], resource: rung}
            return _fold_scores(estimator, entry, folded, label, prediction, fold, folds, judge)

        with ThreadPool(min(parallelism, len(left))) as pool:
            scores = pool.map(inheritable_thread_target(folded.sparkSession)(trial), left)
        known |= {i: (rung, s) for i, s in zip(left, scores)}
        # The first of equal means goes on, as it wins in the end.
        ranked = sorted(left, key=lambda i: (-statistics.fmean(known[i][1]), i))
        left = ranked[:max(1, math.ceil(len(ranked) / factor))] if n + 1 < len(rungs) else ranked
    best = left[0]
    rows = [(i, settings(grid[i]), statistics.fmean(s), statistics.pstdev(s), rung, i == best)
            for i, (rung, s) in sorted(known.items())]
    table = local_rows(folded.sparkSession, rows,
                       f"trial int, settings string, mean_{metric} double, std_{metric} double, tried int, best boolean")
    return estimator.fit(folded, {**grid[best], **({resource: full} if halving else {})}), table
