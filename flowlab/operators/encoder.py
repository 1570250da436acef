"""Category codes fitted once and kept with the models, so that new rows get the training codes."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader,
    MLWritable, MLWriter,
)
from pyspark.sql import DataFrame, functions as F

from flowlab.functions.columns import col
from flowlab.functions.small import settle
from flowlab.operators.prepare import categories, category

CODES = "column string, category string, code bigint"
UNSEEN = ("error", "keep", "null")


class _Settings(HasInputCols, HasOutputCols):
    nullValue = Param(Params._dummy(), "nullValue", "text that a missing value counts as", TypeConverters.toString)
    unseen = Param(Params._dummy(), "unseen", "a category without a code: an error, a code of its own "
                   "after all others (keep), or null", TypeConverters.toString)
    vectors = Param(Params._dummy(), "vectors", "whether to give sparse indicators, not codes", TypeConverters.toBoolean)


class CategoryEncoder(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Codes 0..k-1 of each input column, in the order of its own type."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, nullValue="unknown", unseen="error", vectors=False):
        super().__init__()
        self._setDefault(nullValue="unknown", unseen="error", vectors=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault(self.unseen) not in UNSEEN:
            raise ValueError(f"unseen is one of {UNSEEN}")

    def _fit(self, dataset: DataFrame) -> "CategoryEncoderModel":
        codes = settle(categories(dataset, self.getInputCols(), self.getOrDefault(self.nullValue))).df
        return self._copyValues(CategoryEncoderModel(codes))


class CategoryEncoderModel(Model, _Settings, MLWritable, MLReadable):
    """`codes` has the code of each category: joined as a broadcast while it is small, else by
    a shuffle."""

    def __init__(self, codes: DataFrame | None = None):
        super().__init__()
        self._setDefault(nullValue="unknown", unseen="error", vectors=False)
        self.codes = codes
        self._sizes: dict[str, int] | None = None

    @property
    def sizes(self) -> dict[str, int]:
        """Categories of each column."""
        if self._sizes is None:
            found = self.codes.groupBy("column").agg(F.count(F.lit(1))).collect()  # a row per column
            self._sizes = {c: 0 for c in self.getInputCols()} | dict(map(tuple, found))
        return self._sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rule, vectors = self.getOrDefault(self.unseen), self.getOrDefault(self.vectors)
        out, kept = dataset, [col(c) for c in dataset.columns if c not in self.getOutputCols()]
        values = {}
        for i, (c, name) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            of_column = self.codes.where(F.col("column") == c).select(
                F.col("category").alias(f"_k{i}"), F.col("code").alias(f"_v{i}"))
            value = category(c, self.getOrDefault(self.nullValue))
            out = out.join(of_column, value == F.col(f"_k{i}"), "left")
            code = F.col(f"_v{i}")
            if rule == "error":
                code = F.coalesce(code, F.raise_error(F.concat(
                    F.lit(f"no code in {c} for "), F.coalesce(value, F.lit("a missing value")))).cast("bigint"))
            elif rule == "keep":
                code = F.coalesce(code, F.lit(self.sizes[c]).cast("bigint"))
            values[name] = code
        out = out.select(*kept, *[v.alias(n) for n, v in values.items()])
        if not vectors:
            return out
        for c, name in zip(self.getInputCols(), self.getOutputCols()):
            size = self.sizes[c] + (rule == "keep")
            # The encoder of Spark takes its size from the codes it is fitted on, here the last one.
            known = dataset.sparkSession.range(max(size, 1) - 1, max(size, 1)).withColumnRenamed("id", name)
            encoder = OneHotEncoder(inputCol=name, outputCol="_vector", dropLast=False).fit(known)
            coded = out.withColumn("_code", F.col(f"`{name}`"))
            some = encoder.transform(coded.withColumn(name, F.coalesce(F.col("_code"), F.lit(0))))
            out = some.withColumn(name, F.when(F.col("_code").isNotNull(), F.col("_vector"))).drop("_vector", "_code")
        return out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: CategoryEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.codes.select("column", "category", "code").write.parquet(f"{path}/codes")


class _Reader(MLReader):
    def load(self, path: str) -> CategoryEncoderModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryEncoderModel(settle(self.sparkSession.read.schema(CODES).parquet(f"{path}/codes")).df)
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
