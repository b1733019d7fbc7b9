"""The forest on bins against MLlib's, and its sums by cell."""

import numpy as np
import pytest
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from colonnade.operators import learning as lr
from colonnade.operators.forests import fit_forest, split_points

NAMES = ["a", "b", "c", "d"]


def frame(spark, n=6000, null=False):
    rng = np.random.default_rng(5)
    x = np.stack([rng.normal(size=n), rng.integers(0, 5, n), rng.uniform(size=n), rng.integers(0, 50, n)], axis=1)
    y = 3 * x[:, 0] + (x[:, 1] > 2) * 4 + np.sin(x[:, 3] / 5) + rng.normal(scale=0.3, size=n)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    return spark.createDataFrame([*rows, (None, 1.0, 1.0, 1.0, 1.0)] if null else rows, "a double, b double, c double, d double, y double")


def test_as_good_as_mllib(spark):
    d = frame(spark).cache()
    error = lambda p: p.agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0]
    own = fit_forest(d, NAMES, "y", trees=60, depth=6)
    m = RandomForestRegressor(labelCol="y", numTrees=60, maxDepth=6, seed=1).fit(lr.as_features(d, NAMES))
    a, b = own.transform(d), m.transform(lr.as_features(d, NAMES))
    assert error(a) == pytest.approx(error(b), rel=0.1)
    both = a.select(*NAMES, F.col("prediction").alias("p")).join(b.select(*NAMES, "prediction"), NAMES)
    assert both.count() == 6000 and both.agg(F.corr("p", "prediction")).first()[0] > 0.99
    assert a.columns == [*d.columns, "prediction"] and len(own.trees) == 60 and len({tuple(t) for t in own.trees}) == 60


def test_rows_reach_the_trees_as_sums(spark):
    """MLlib keeps a count for each row and tree; here no more than the cells travel."""
    d = spark.range(200000).select((F.col("id") % 4).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b"), (F.col("id") % 7).cast("double").alias("y"))
    m = fit_forest(d, ["a", "b"], "y", trees=20, depth=3)
    assert [len(p) for p in m.points] == [3, 2]
    got = m.transform(d).groupBy("a", "b").agg(F.avg("y").alias("y"), F.avg("prediction").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    assert len(got) == 12 and sum(r.n for r in got) == 200000 and all(r.p == pytest.approx(r.y, abs=0.05) for r in got)


def test_splits_and_refusals(spark):
    few, many = split_points(frame(spark), ["b", "a"], 32)
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5] and len(many) == 31 and (np.diff(many) > 0).all()
    with pytest.raises(ValueError):
        fit_forest(frame(spark, 50, null=True), NAMES, "y", trees=2, depth=2)
    m = fit_forest(frame(spark, 50), NAMES, "y", trees=2, depth=2)
    p = m.transform(frame(spark, 50, null=True))
    assert p.count() == 51 and p.filter("prediction is null").count() == 1
