"""The forecasters as Spark ML estimators: params, fitting, saving and loading.

``fit`` takes rows of both splits and learns from the train rows; the model's ``transform`` takes rows of
both splits and adds the prediction column. What a model learnt is a table (one row per zone, or Spark
ML's own trees), so saving and loading pass nothing through the driver.
"""

from __future__ import annotations

from collections.abc import Mapping
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.config import SEED, SEQUENCE_LENGTH
from gridcast.operators import forecast, sequence
from gridcast.operators.features import add_clock_lags
from gridcast.session import materialize

SIDE_BY_SIDE = 4  # settings fitted at once; each keeps binned rows of its own


class _Columns(Params):
    features = Param(Params._dummy(), "features", "input columns", TypeConverters.toListString)
    target = Param(Params._dummy(), "target", "column to forecast", TypeConverters.toString)
    out = Param(Params._dummy(), "out", "prediction column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(features=[], target="requirement", out="pred")

    def get(self, name: str):
        return self.getOrDefault(name)


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        for name, table in self.instance.tables().items():
            table.write.parquet(f"{path}/{name}")
        if getattr(self.instance, "trees", None) is not None:
            self.instance.trees.write().save(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])
        model.load_from(spark, path)
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class ForecastModel(Model, _Columns, MLWritable, MLReadable):
    """A fitted forecaster."""

    def tables(self) -> dict[str, DataFrame]:
        """What was learnt, as tables to save."""
        return {}

    def load_from(self, spark, path: str) -> None:
        """Read back what ``tables`` names."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def featureImportances(self) -> DataFrame:
        """(zone, feature, importance), adding up to 1 in every zone; no rows where nothing is weighed."""
        raise NotImplementedError


class _CoefModel(ForecastModel):
    """``coefs(zone, coef, scale)``: a line per zone, and the deviations of its inputs."""

    def __init__(self, coefs: DataFrame | None = None):
        super().__init__()
        self.coefs = coefs

    def tables(self):
        return {"coefs": self.coefs}

    def load_from(self, spark, path):
        self.coefs = spark.read.parquet(f"{path}/coefs")

    def featureImportances(self):
        names = self.get("features")
        inputs = F.explode(F.transform(F.sequence(F.lit(1), F.size("coef") - 1), lambda i: F.struct(
            F.element_at(F.array(*[F.lit(n) for n in names]), (i - 1) % len(names) + 1).alias("feature"),
            F.abs(F.get("coef", i) * F.get("scale", i - 1)).alias("x"))))
        each = self.coefs.select("zone", inputs.alias("_i")).groupBy("zone", "_i.feature").agg(F.sum("_i.x").alias("x"))
        total = each.groupBy("zone").agg(F.sum("x").alias("total"))
        return each.join(total, "zone").select("zone", "feature", F.coalesce(F.try_divide("x", "total"), F.lit(0.0)).alias("importance"))


def _solved(sums: DataFrame, size: int, penalty: float) -> DataFrame:
    """(zone, coef, scale) from moments per zone."""
    sums = materialize(sums)
    return materialize(forecast.ridge_solve(sums, ["zone"], size, [penalty]).select("zone", "coef").join(
        forecast.deviations(sums, ["zone"], size), "zone"))


class RidgeModel(_CoefModel):
    def _transform(self, df):
        out = self.get("out")
        line = self.coefs.select("zone", F.col("coef").alias("_coef"))
        return df.join(line, "zone", "left").withColumn(out, forecast.linear_score(F.col("_coef"), self.get("features"))).select(*df.columns, out)


class RidgeForecaster(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge regression per zone."""

    penalty = Param(Params._dummy(), "penalty", "ridge penalty on scaled features", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, features=None, target="requirement", out="pred", penalty=1e-3):
        super().__init__()
        self._setDefault(penalty=1e-3)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        columns = [*self.get("features"), self.get("target")]
        sums = forecast.moments(df.where(F.col("split") == "train"), ["zone"], columns)
        return self._copyValues(RidgeModel(_solved(sums, len(columns) - 1, self.get("penalty"))))


class _Window(Params):
    length = Param(Params._dummy(), "length", "rows of a window", TypeConverters.toInt)
    carry = Param(Params._dummy(), "carry", "whether test windows begin in the train rows", TypeConverters.toBoolean)
    grid = Param(Params._dummy(), "grid", "whether the series is complete on its grid", TypeConverters.toBoolean)


class SequenceModel(_CoefModel, _Window):
    def _transform(self, df):
        return sequence.sequence_predict(df, self.coefs.select("zone", "coef"), self.get("features"), self.get("length"), self.get("out"),
                                         self.get("carry"), self.get("grid"))


class SequenceForecaster(Estimator, _Columns, _Window, DefaultParamsReadable, DefaultParamsWritable):
    """Ridge regression per zone on the rows before a row."""

    penalty = Param(Params._dummy(), "penalty", "ridge penalty on scaled features", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, features=None, target="requirement", out="pred", length=SEQUENCE_LENGTH, carry=True, grid=False, penalty=1e-3):
        super().__init__()
        self._setDefault(length=SEQUENCE_LENGTH, carry=True, grid=False, penalty=1e-3)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        length, names = self.get("length"), self.get("features")
        sums = sequence.sequence_sums(df, names, self.get("target"), length, self.get("carry"), self.get("grid"))
        return self._copyValues(SequenceModel(_solved(sums, length * len(names), self.get("penalty"))))


class NaiveModel(ForecastModel):
    hours = Param(Params._dummy(), "hours", "how far back the same slot is taken", TypeConverters.toInt)

    def _transform(self, df):
        return add_clock_lags(df, {self.get("out"): self.get("hours")}, self.get("target"))

    def featureImportances(self):
        return SparkSession.active().createDataFrame([], "zone string, feature string, importance double")


class NaiveForecaster(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """The value of the same slot ``hours`` earlier."""

    hours = NaiveModel.hours

    @keyword_only
    def __init__(self, *, features=None, target="requirement", out="pred", hours=168):
        super().__init__()
        self._setDefault(hours=168)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        return self._copyValues(NaiveModel())


class TreeModel(ForecastModel):
    """Spark ML's boosted trees on loads divided by their zone's level."""

    loads = Param(Params._dummy(), "loads", "features in load units", TypeConverters.toListString)

    def __init__(self, trees: GBTRegressionModel | None = None, scale: DataFrame | None = None):
        super().__init__()
        self.trees, self.scale = trees, scale

    def tables(self):
        return {"scale": self.scale}

    def load_from(self, spark, path):
        self.trees, self.scale = GBTRegressionModel.load(f"{path}/trees"), spark.read.parquet(f"{path}/scale")

    def _fitted(self) -> forecast.GbtFit:
        names = self.get("features")
        assembler = VectorAssembler(inputCols=[f"_f_{f}" for f in names], outputCol="_features")
        return forecast.GbtFit(self.trees, assembler, names, set(self.get("loads")), self.scale)

    def _transform(self, df):
        return self._fitted().predict(df, self.get("out"))

    def featureImportances(self):
        scores = self.trees.featureImportances.toArray().tolist()
        cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(float(s)).alias("importance")) for f, s in zip(self.get("features"), scores)])
        return self.scale.select("zone", F.inline(cells))


class TreeForecaster(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees, one distributed fit over all zones."""

    trees = Param(Params._dummy(), "trees", "boosting rounds", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "depth of a tree", TypeConverters.toInt)
    step = Param(Params._dummy(), "step", "learning rate", TypeConverters.toFloat)
    sample = Param(Params._dummy(), "sample", "share of rows for a tree", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the row samples", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, features=None, target="requirement", out="pred", trees=300, depth=6, step=0.05, sample=0.9, seed=SEED):
        super().__init__()
        self._setDefault(trees=300, depth=6, step=0.05, sample=0.9, seed=SEED)
        self._set(**self._input_kwargs)

    def _rows(self, df):
        return forecast.GbtRows(df.where(F.col("split") == "train"), self.get("features"), self.get("target"))

    def _fit(self, df):
        return self._model(rows := self._rows(df), lambda: materialize(rows.scale))

    def _model(self, rows, scale):
        fit = rows.fit(self.get("trees"), self.get("depth"), self.get("step"), self.get("sample"), self.get("seed"))
        return self._copyValues(TreeModel(fit.model, scale())._set(loads=sorted(fit.loads)))

    def fitMultiple(self, dataset, paramMaps):
        """Settings that change neither features nor target share their rows: these are scaled once, kept while
        the trees of all settings are fitted, and looked at in the same order as by a fit alone. Trees grow one after
        the other, a small job a level, so some settings are fitted side by side."""
        each = [self.copy(m) for m in paramMaps]
        if len({(*own.get("features"), own.get("target")) for own in each}) != 1:
            return super().fitMultiple(dataset, paramMaps)
        return self._together(each[0]._rows(dataset), each)

    @staticmethod
    def _together(rows, each):
        rows.ready = rows.ready.persist()
        try:
            scale = materialize(rows.scale)
            rows.ready.count()  # scaled before the settings ask for them at once
            fit = inheritable_thread_target(rows.ready.sparkSession)(lambda own: own._model(rows, lambda: scale))
            with ThreadPool(min(SIDE_BY_SIDE, len(each))) as pool:
                yield from enumerate(pool.imap(fit, each))
        finally:
            rows.ready.unpersist()


def tree_forecaster(setting: Mapping[str, float], **more) -> TreeForecaster:
    """A tree forecaster from a setting in Spark ML's names, such as those of ``config``."""
    return TreeForecaster(trees=setting["maxIter"], depth=setting["maxDepth"], step=setting["stepSize"], sample=setting["subsamplingRate"], **more)
