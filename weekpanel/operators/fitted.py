"""Fitted models of this package as ``pyspark.ml`` stages.

A model holds plain numbers (its size is the model's, not the data's) and is
saved as the JSON metadata of an ordinary ``PipelineModel``."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class _Writer(MLWriter):
    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"fitted": self.model.numbers()})


class _Reader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind.of(metadata["fitted"])
        model._resetUid(metadata["uid"])
        return model


class Classifier(Model, MLWritable, MLReadable):
    """Two classes: ``features`` in, ``probability`` (a vector of two) and ``prediction`` out."""

    def numbers(self) -> dict:
        raise NotImplementedError

    @classmethod
    def of(cls, numbers: dict):
        raise NotImplementedError

    def margin(self, features: Column) -> Column:
        """Log-odds of class 1."""
        raise NotImplementedError

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = dataset.withColumn("margin", self.margin(F.col("features")))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        out = out.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
        return out.withColumn("prediction", (F.col("margin") > 0).cast("double"))
