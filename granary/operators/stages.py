"""Fit and transform as pipeline stages that are saved and loaded with what they have learnt.

What a stage learns is a table (a row for each term), not a list on the driver: it is written
beside the stage's parameters, and a loaded stage joins it like any other table.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.text import tokens
from granary.operators.text import term_counts
from granary.session import durable


class ColumnSelector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the named columns."""

    columns = Param(Params._dummy(), "columns", "names of the columns to keep", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*self.getOrDefault(self.columns))


class TermCounter(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(id, term, tf) rows of a text column."""

    idCol = Param(Params._dummy(), "idCol", "column of the row's id", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "column of the text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, idCol: str = "id", textCol: str = "text"):
        super().__init__()
        self._setDefault(idCol="id", textCol="text")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return term_counts(dataset, self.getOrDefault(self.idCol), tokens(F.col(self.getOrDefault(self.textCol))))


class _TermParams(Params):
    idCol = Param(Params._dummy(), "idCol", "column of the row's id", TypeConverters.toString)
    minDf = Param(Params._dummy(), "minDf", "least number of rows with a kept term", TypeConverters.toInt)
    maxDf = Param(Params._dummy(), "maxDf", "largest share of rows with a kept term", TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(idCol="id", minDf=1, maxDf=1.0)


class TermWeigher(Estimator, _TermParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which terms to keep and their smoothed inverse document frequencies, from (id, term, tf) rows."""

    @keyword_only
    def __init__(self, *, idCol: str = "id", minDf: int = 1, maxDf: float = 1.0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TermWeigherModel:
        total = dataset.select(self.getOrDefault(self.idCol)).distinct().agg(F.count(F.lit(1))).scalar()
        seen = dataset.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        kept = seen.where((F.col("df") >= self.getOrDefault(self.minDf)) & (F.col("df") <= total * self.getOrDefault(self.maxDf)))
        weights = kept.select("term", "df", (F.ln((1 + total) / (1 + F.col("df"))) + 1).alias("idf"))
        return self._copyValues(TermWeigherModel(durable(weights)))


class TermWeigherModel(Model, _TermParams, MLReadable, MLWritable):
    """Keeps the learnt terms of (id, term, tf) rows and weighs them."""

    def __init__(self, weights: DataFrame | None = None):
        super().__init__()
        self.weights = weights

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.join(self.weights.select("term", "idf"), "term").select(
            self.getOrDefault(self.idCol), "term", "tf", (F.col("tf") * F.col("idf")).alias("weight")
        )

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _TableWriter(MLWriter):
    def __init__(self, instance: TermWeigherModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.weights.write.parquet(f"{path}/weights")


class _TableReader(MLReader):
    def __init__(self, cls: type[TermWeigherModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TermWeigherModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.parquet(f"{path}/weights"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
