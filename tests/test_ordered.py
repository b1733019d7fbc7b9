"""Ordered operators against pandas, with one key owning a third of the rows and tiny blocks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from colonnade.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(0)
    n = 3000
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 40, n))
    v = np.where(rng.random(n) < 0.35, 5.0, np.round(rng.normal(0, 10, n), 2))
    v = pd.Series(v).mask(pd.Series(rng.random(n) < 0.1))
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v"))).repartition(7)
    return pdf, df


def test_position(skewed):
    pdf, df = skewed
    got = ordered.with_position(df.na.fill(0.0), ["v", "id"]).orderBy("id").toPandas()
    want = pdf.fillna(0.0).sort_values(["v", "id"]).reset_index(drop=True).reset_index().sort_values("id")["index"]
    assert got["pos"].tolist() == want.tolist()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running(skewed, keys):
    pdf, df = skewed
    got = ordered.running(df, keys, ["id"], {"s": ("sum", F.lit(1)), "m": ("max", F.col("v")), "l": ("last", F.col("v")), "b": ("next", F.col("v"))}).orderBy("id").toPandas()
    p = pdf.sort_values("id")
    g = p.groupby("k") if keys else p.assign(z=0).groupby("z")
    assert got["s"].tolist() == (g.cumcount() + 1).tolist()
    pd.testing.assert_series_equal(got["l"], g["v"].ffill().reset_index(drop=True), check_names=False)
    pd.testing.assert_series_equal(got["b"], g["v"].bfill().reset_index(drop=True), check_names=False)
    want_max = g["v"].transform(lambda s: s.cummax().ffill()).reset_index(drop=True)
    pd.testing.assert_series_equal(got["m"], want_max, check_names=False)


@pytest.mark.parametrize("block", [8, 50, 1 << 16])
def test_framed(skewed, block):
    pdf, df = skewed
    fns = {"lag": lambda w, f: F.lag("id", 3).over(w), "lead": lambda w, f: F.lead("id", 2).over(w), "n": lambda w, f: F.count(F.lit(1)).over(f)}
    got = ordered.framed(df, ["k"], ["id"], 3, 2, fns, block=block).orderBy("id").toPandas()
    g = pdf.sort_values("id").groupby("k")["id"]
    pd.testing.assert_series_equal(got["lag"], g.shift(3), check_names=False, check_dtype=False, check_index=False)
    pd.testing.assert_series_equal(got["lead"], g.shift(-2), check_names=False, check_dtype=False, check_index=False)
    assert len(got) == len(pdf) and got["n"].max() == 6


@pytest.mark.parametrize("small", [1, 1 << 30])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_percentiles(skewed, keys, small, monkeypatch):
    pdf, df = skewed
    monkeypatch.setattr(ordered, "_SMALL", small)
    monkeypatch.setattr(ordered, "_MARGIN", 0.2)  # wide enough for a few dozen rows per group
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = ordered.exact_percentiles(df, keys, "v", probs).toPandas()
    q = pdf.groupby("k")["v"] if keys else pdf.assign(k=0).groupby("k")["v"]
    want = q.quantile(list(probs.values())).unstack()
    got = (got.set_index("k") if keys else got).sort_index()[list(probs)]
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy())


def test_percentiles_large_group_uses_narrow_brackets(spark):
    d = spark.range(200000).select((F.xxhash64("id") % 1000003).cast("double").alias("v"), (F.col("id") % 3).alias("k"))
    got = ordered.exact_percentiles(d, [], "v", {"q1": 0.25, "med": 0.5, "q3": 0.75}).first()
    v = d.toPandas()["v"]
    assert list(got) == [v.quantile(p) for p in (0.25, 0.5, 0.75)]
    by = ordered.exact_percentiles(d, ["k"], "v", {"med": 0.5}).toPandas().set_index("k")["med"].sort_index()
    assert by.tolist() == d.toPandas().groupby("k")["v"].median().tolist()


def test_running_carries_a_null_key(spark):
    d = spark.range(40_000).select("id", F.lit(None).cast("int").alias("k"))
    got = ordered.running(d.repartition(8), ["k"], ["id"], {"n": ("sum", F.lit(1))})
    assert got.agg(F.max("n")).first()[0] == 40_000 and got.filter("n <> id + 1").count() == 0


def test_percentiles_keep_the_null_group_at_any_size(spark):
    d = spark.range(120_000).select(F.when(F.col("id") % 2 == 0, 1).alias("k"), (F.col("id") / 2).cast("int").cast("double").alias("v"))
    got = {r.k: r.m for r in ordered.exact_percentiles(d, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {1: 29_999.5, None: 29_999.5}
