"""A grid of margin classifiers fitted side by side against the same models fitted one by one."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from colonnade.operators.margins import fit_margin_grid

GRID = [(3, 0.001), (6, 0.1)]


def frame(spark):
    rng = np.random.default_rng(2)
    centres, y = rng.normal(size=(3, 6)), rng.integers(0, 3, 200)
    x = centres[y] + rng.normal(size=(200, 6)) * np.linspace(2, 0.3, 6) + 0.3
    x[:, 4] = 1.5  # no spread
    return spark.createDataFrame([(float(a), b.tolist()) for a, b in zip(y, x)], "label double, v array<double>")


def test_same_models_as_one_by_one(spark):
    d = frame(spark).withColumn("f", array_to_vector("v")).cache()
    got = fit_margin_grid(d, "v", "label", GRID, 5)
    shares = got.accuracies(d, "v", "label")
    for i, (k, reg) in enumerate(GRID):
        first = VectorSlicer(inputCol="f", outputCol="first", indices=list(range(k)))
        one = Pipeline(stages=[first, OneVsRest(featuresCol="first", classifier=LinearSVC(featuresCol="first", regParam=reg, maxIter=5))]).fit(d)
        for c, m in enumerate(one.stages[-1].models):
            assert np.allclose(got.weights[i, c, :k], m.coefficients.toArray(), atol=1e-9) and not got.weights[i, c, k:].any()
            assert abs(got.intercepts[i, c] - m.intercept) < 1e-9
        assert shares[i] == one.transform(d).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_passes_do_not_grow_with_the_grid(spark):
    """One by one, sixteen settings took sixteen times the jobs of one."""
    d = frame(spark).cache()
    d.count()

    def jobs(grid):
        group = f"grid of {len(grid)}"
        spark.sparkContext.setJobGroup(group, group)
        fit_margin_grid(d, "v", "label", grid, 2)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    few, many = jobs([(6, 0.1)]), jobs([(k, r) for k in (3, 4, 5, 6) for r in (0.001, 0.01, 0.1, 1.0)])
    assert few > 0 and many < 4 * few
