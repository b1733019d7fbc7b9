"""Custom estimators in the ML API: fit on a DataFrame, transform lazily."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from colonnade.operators.kernels import gaussian_sums


class _BumpParams(HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    outputPrefix = Param(Params._dummy(), "outputPrefix", "prefix of the new columns", TypeConverters.toString)
    count = Param(Params._dummy(), "count", "number of bumps", TypeConverters.toInt)
    centres = Param(Params._dummy(), "centres", "fitted centres", TypeConverters.toListFloat)
    width = Param(Params._dummy(), "width", "fitted width", TypeConverters.toFloat)


class GaussianBumps(Estimator, _BumpParams):
    """Gaussian basis columns spread evenly over the range of one input column."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputPrefix="bump", count=10):
        super().__init__()
        self._setDefault(outputPrefix="bump", count=10)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        col = self.getOrDefault(self.inputCol)
        lo, hi = dataset.agg(F.min(col), F.max(col)).first()
        n = self.getOrDefault(self.count)
        step = (hi - lo) / max(n - 1, 1)
        model = GaussianBumpsModel()
        self._copyValues(model)
        model._set(centres=[float(lo + step * i) for i in range(n)], width=float(step) or 1.0)
        return model


class GaussianBumpsModel(Model, _BumpParams):
    def _transform(self, dataset):
        x, w = F.col(self.getOrDefault(self.inputCol)), self.getOrDefault(self.width)
        prefix = self.getOrDefault(self.outputPrefix)
        new = {}
        for i, c in enumerate(self.getOrDefault(self.centres)):
            u = (x - F.lit(c)) / F.lit(w)
            new[f"{prefix}{i}"] = F.exp(-0.5 * u * u)
        return dataset.withColumns(new)


class _DensityParams(HasInputCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    bandwidth = Param(Params._dummy(), "bandwidth", "kernel width", TypeConverters.toFloat)


class DensityClassifier(Estimator, _DensityParams):
    """Bayes classifier with a kernel density per class over one column.

    The training data is reduced to counts per (class, value); the model is that table, and densities are sums over its bins.
    """

    @keyword_only
    def __init__(self, *, inputCol=None, labelCol="label", bandwidth=1.0):
        super().__init__()
        self._setDefault(labelCol="label", bandwidth=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        x, y = self.getOrDefault(self.inputCol), self.getOrDefault(self.labelCol)
        model = DensityClassifierModel()
        self._copyValues(model)
        model.counts = dataset.groupBy(F.col(y).alias("_c"), F.col(x).alias("_v")).agg(F.count(F.lit(1)).alias("_k"))
        return model


class DensityClassifierModel(Model, _DensityParams):
    counts = None

    def scores(self, dataset):
        """Posterior per distinct input value and class."""
        x, h = self.getOrDefault(self.inputCol), self.getOrDefault(self.bandwidth)
        points = self.counts.select(F.col("_c").alias("c"), F.col("_v").alias("x"), F.col("_k").alias("n"))
        values = dataset.select(F.col(x).alias("x")).distinct()
        classes = self.counts.agg(F.collect_set("_c")).scalar()  # one entry per class
        pairs = values.withColumn("c", F.explode(classes))
        # class prior times class density is the kernel sum over the class, up to a common factor
        found = pairs.join(gaussian_sums(points, values, h), ["x", "c"], "left")
        return found.select(F.col("x").alias("_x"), F.col("c").alias("_c"), (F.coalesce("s", F.lit(0.0)) / (h * math.sqrt(2 * math.pi))).alias("_s"))

    def _transform(self, dataset):
        x = self.getOrDefault(self.inputCol)
        s = self.scores(dataset).groupBy("_x").agg(
            F.max_by("_c", F.struct("_s", (-F.col("_c")).alias("_tie"))).alias("prediction"), F.try_divide(F.max("_s"), F.sum("_s")).alias("probability")
        )
        return dataset.join(s, dataset[x] == s["_x"]).drop("_x")
