"""Gaussian naive Bayes with variance smoothing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol,
)
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

# Fixed value: share of the largest feature variance added to every variance.
SMOOTHING = 1e-5


def class_sums(rows: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, means and population variances from summaries `s` of count, mean, variance."""
    n = np.array([float(r["s"]["count"]) for r in rows])
    mean = np.array([r["s"]["mean"].toArray() for r in rows])
    return n, mean, np.array([r["s"]["variance"].toArray() for r in rows]) * ((n - 1) / n)[:, None]


def smoothed(n: np.ndarray, mean: np.ndarray, var: np.ndarray, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """Log priors, and variances with a share of the largest variance over all rows added."""
    share = (n / n.sum())[:, None]
    centre = (share * mean).sum(axis=0)
    overall = (share * (var + (mean - centre) ** 2)).sum(axis=0)
    return np.log(n / n.sum()), var + smoothing * overall.max()


def score_matrix(prior: np.ndarray, mean: np.ndarray, var: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A centre, and the matrix that gives each class's log score as the product with
    (d * d, d, 1), d being a row's distance from the centre."""
    centre = mean.mean(axis=0)
    offset, precision = mean - centre, 0.5 / var
    constant = prior - 0.5 * np.log(2.0 * np.pi * var).sum(axis=1) - (offset * offset * precision).sum(axis=1)
    return centre, np.concatenate([-precision, 2.0 * offset * precision, constant[:, None]], axis=1).T


def log_scores(x: np.ndarray, centre: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    d = x - centre
    return np.concatenate([d * d, d, np.ones((len(d), 1))], axis=1) @ matrix


class GaussianBayes(
    Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Per-class mean and population variance of each feature, from one aggregation."""

    smoothing = Param(Params._dummy(), "smoothing", "share of the largest variance to add",
                      TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 probabilityCol="probability", smoothing=SMOOTHING):
        super().__init__()
        self._setDefault(smoothing=SMOOTHING)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "GaussianBayesModel":
        stats = Summarizer.metrics("count", "mean", "variance").summary(F.col(self.getFeaturesCol()))
        rows = sorted(
            dataset.groupBy(F.col(self.getLabelCol()).cast("double").alias("c"))
            .agg(stats.alias("s")).collect(),  # one row per class
            key=lambda r: r["c"],
        )
        n, mean, var = class_sums(rows)
        priors, var = smoothed(n, mean, var, self.getOrDefault(self.smoothing))
        model = GaussianBayesModel(
            classes=[float(r["c"]) for r in rows], priors=priors.tolist(),
            means=mean.tolist(), variances=var.tolist())
        return self._copyValues(model)


class GaussianBayesModel(
    Model, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    smoothing = GaussianBayes.smoothing
    classes = Param(Params._dummy(), "classes", "class labels, ascending", TypeConverters.toListFloat)
    priors = Param(Params._dummy(), "priors", "log share of each class", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean per class and feature", TypeConverters.toList)
    variances = Param(Params._dummy(), "variances", "variance per class and feature",
                      TypeConverters.toList)

    @keyword_only
    def __init__(self, *, classes=None, priors=None, means=None, variances=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        label, *parts = (np.array(self.getOrDefault(p), dtype=float)
                         for p in (self.classes, self.priors, self.means, self.variances))
        centre, matrix = score_matrix(*parts)
        width = len(centre)

        @F.arrow_udf("struct<prediction:double,probability:array<double>>")
        def score(batch: pa.Array) -> pa.Array:
            joint = log_scores(batch.flatten().to_numpy(zero_copy_only=False).reshape(-1, width), centre, matrix)
            best = joint.argmax(axis=1)  # the smallest class on a tie
            share = np.exp(joint - joint.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            at = np.arange(len(joint) + 1, dtype=np.int32) * len(label)
            return pa.StructArray.from_arrays(
                [pa.array(label[best]), pa.ListArray.from_arrays(at, pa.array(share.reshape(-1)))],
                ["prediction", "probability"])

        return dataset.withColumn(
            "_bayes", score(vector_to_array(F.col(self.getFeaturesCol())))).withColumns({
                self.getPredictionCol(): F.col("_bayes.prediction"),
                self.getProbabilityCol(): array_to_vector(F.col("_bayes.probability")),
            }).drop("_bayes")
