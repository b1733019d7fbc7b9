"""Sums of Gaussian kernels over any number of values, by expansions in bins.

With ``t = (x - c) / (h sqrt 2)`` and ``s = (v - c) / (h sqrt 2)`` around a bin's middle ``c``, the kernel of ``x`` and ``v`` is
``exp(-t^2) * sum_k (2 t)^k * s^k exp(-s^2) / k!``: sums over a bin's values are ``TERMS`` numbers, whatever their count, and a place needs the bins
around its own only. A bin is half a bandwidth wide, so ``|s| <= 0.177``; leaving out the terms from ``TERMS`` on changes a kernel by less than
``1e-13`` of its height, and bins beyond ``REACH`` hold less than ``1e-17`` of it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TERMS, REACH = 14, 18
#: Bound of the error of a sum, as a share of the number of values times the kernel's height.
ERROR = 2e-13


def gaussian_sums(points: DataFrame, at: DataFrame, width: float) -> DataFrame:
    """``x``, ``c``, ``s``: for every ``x`` of ``at`` and class ``c`` of ``points`` (``c``, ``x``, weight ``n``) near it the sum of ``n exp(-d^2 / 2 width^2)``.

    A pair without a row has a sum of 0 within the bound. Nulls and non-finite values are left out on both sides. A bin is one
    row after partial sums, so a value or a bin of any weight costs nothing more; a place meets its own bin's row per class.
    """
    side, scale = width / 2, width * math.sqrt(2)
    fine = lambda d: d.filter("x is not null and not isnan(x) and abs(x) < double('infinity')").withColumn("bin", F.floor(F.col("x") / side))
    s = (F.col("x") - (F.col("bin") + 0.5) * side) / scale
    src = fine(points.withColumn("x", F.col("x").cast("double"))).withColumn("s", s)
    moments = [F.sum(F.col("n") * F.pow("s", F.lit(float(k))) * F.exp(-F.col("s") * F.col("s")) / math.factorial(k)).alias(f"m{k}") for k in range(TERMS)]
    bins = src.groupBy("c", "bin").agg(*moments).select("c", "bin", F.array(*[F.col(f"m{k}") for k in reversed(range(TERMS))]).alias("m"))
    asked = fine(at.select(F.col("x").cast("double").alias("x"))).distinct()
    near = bins.withColumn("off", F.explode(F.sequence(F.lit(-REACH), F.lit(REACH)))).select("c", (F.col("bin") - F.col("off")).alias("bin"), "off", "m")
    near = near.join(asked.select("bin").distinct(), "bin", "left_semi").groupBy("bin", "c").agg(F.collect_list(F.struct("off", "m")).alias("near"))  # at most 2 REACH + 1 bins

    def part(total, e):
        t = (F.col("x") - (F.col("bin") + e["off"] + 0.5) * side) / scale
        return total + F.exp(-t * t) * F.aggregate(e["m"], F.lit(0.0), lambda a, m: a * (2 * t) + m)

    return asked.join(near, "bin").select("x", "c", F.greatest(F.aggregate("near", F.lit(0.0), part), F.lit(0.0)).alias("s"))
