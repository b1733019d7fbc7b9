"""Formulas and small fixtures with known answers."""

import math

import pytest
from pyspark.sql import functions as F

from colonnade.functions import bins, geo, special
from colonnade.functions import text as tx
from colonnade.operators import learning as lr
from colonnade.operators import stats
from colonnade.operators.relational import null_safe_join


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


@pytest.mark.parametrize("x", [-3.2, -1.0, -0.1, 0.0, 0.4, 2.4999, 2.5, 4.0])
def test_erf(spark, x):
    a, b = _one(spark, special.erf(F.lit(x)), special.erfc(F.lit(x)))
    assert a == pytest.approx(math.erf(x), abs=1e-13)
    assert b == pytest.approx(math.erfc(x), rel=1e-10)


@pytest.mark.parametrize("x", [0.1, 0.5, 1.0, 3.3, 20.0])
def test_gamma(spark, x):
    assert _one(spark, special.lgamma(F.lit(x)))[0] == pytest.approx(math.lgamma(x), abs=1e-10)


def test_normal_quantile(spark):
    for p, z in ((0.95, 1.6448536269514722), (0.5, 0.0), (1e-6, -4.753424308822899)):
        assert _one(spark, special.norm_ppf(F.lit(p)))[0] == pytest.approx(z, abs=1e-9)


def test_t_pvalue(spark):
    # with one degree of freedom the tail is an arctangent; t = 1 gives exactly one half
    df = spark.createDataFrame([(1.0, 1), (2.0, 10), (12.706204736432095, 1)], "t double, df int")
    p = [r["p"] for r in stats.with_t_pvalue(df, "t", "df").collect()]
    assert p == pytest.approx([0.5, 0.07338803477074, 0.05], abs=1e-9)


def test_text(spark):
    row = _one(
        spark, tx.clean_sensor_label(F.lit("  wec_01  ")), tx.clean_sensor_label(F.lit("WEC-2")), tx.clock_seconds(F.lit("1:02:03")),
        tx.rfind(F.lit("the quick the"), "the"), tx.rfind(F.lit("none"), "the"), tx.centred(F.lit("ab"), 5, "*"), tx.swap_case(F.lit("aBc")), tx.capitalise(F.lit("hELLO")),
    )
    assert list(row) == ["WEC-01", "WEC-02", 3723, 10, -1, "*ab**", "AbC", "Hello"]


@pytest.mark.parametrize("s", ["x a@b.com y", "a@b.comx@y.org", "no at", "@@", "a.b@c-d.net,e@f.com", "x@y", "q@r.comm@n.edu", "a.b@mail.info", "x@y.co.uk.", "jo+1@ex-ample.com"])
def test_email_mask_equals_plain_pattern(spark, s):
    import re

    plain = r"(?a:[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    got = _one(spark, tx.mask_emails(F.lit(s)), tx.count_emails(F.lit(s)))
    assert list(got) == [re.sub(plain, "[address]", s), len(re.findall(plain, s))]


def test_cut_is_right_closed(spark):
    d = spark.createDataFrame([(0.0,), (0.1,), (18.0,), (18.5,), (80.0,), (81.0,)], "v double")
    assert [r[0] for r in d.select(bins.cut("v", [0.0, 18.0, 80.0])).collect()] == [None, 0, 0, 1, 1, None]


def test_null_safe_join(spark):
    a = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    b = spark.createDataFrame([(None, 9), (3, 8)], "k int, b int")
    assert [tuple(r) for r in null_safe_join(a, b, "k").collect()] == [(None, 1, 9)]


def test_power_curve_regions(spark):
    v = [3.9, 4.0, 13.0, 13.1, 25.0, 25.1]
    d = spark.createDataFrame([(x,) for x in v], "v double").select(geo.turbine_power(F.col("v"))).collect()
    kw = [r[0] for r in d]
    assert kw[0] == 0 and 0 < kw[1] < 200 and kw[3] == kw[4] == 2000 and kw[5] == 0


def test_confusion_of_ten_sites(spark):
    rows = [(1, 1), (1, 0), (0, 0), (0, 1), (1, 1), (0, 0), (1, 0), (0, 0), (1, 1), (0, 0)]
    d = spark.createDataFrame(rows, "label int, pred int")
    c = d.agg(*[x.alias(n) for n, x in lr.binary_counts("label", F.col("pred") == 1).items()])
    assert c.first().asDict() == {"tp": 3, "fp": 1, "fn": 2, "tn": 4}
    r = c.select(*[x.alias(n) for n, x in lr.ratios().items()]).first()
    assert list(r) == pytest.approx([0.75, 0.6, 2 / 3])


def test_auc_equals_rank_identity(spark):
    d = spark.range(500).select((F.pmod(F.xxhash64("id"), F.lit(2))).cast("int").alias("label"), (F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(40))).alias("score"))
    got = lr.roc_auc(d, "label", "score").first()[0]
    p = d.toPandas()
    pos, neg = p[p.label == 1].score.to_numpy(), p[p.label == 0].score.to_numpy()
    want = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert got == pytest.approx(want)


def test_density_integrates_to_one(spark):
    d = spark.range(200).select((F.col("id") % 37).cast("double").alias("v"))
    grid = [-20 + 0.5 * i for i in range(160)]
    total = stats.kde(d, [], "v", grid, 3.0).agg(F.sum("density") * 0.5).first()[0]
    assert total == pytest.approx(1.0, abs=1e-6)


def test_hex_cells_tile_the_plane(spark):
    # every point is at most one circumradius from the centre of its cell
    d = spark.range(2000).select((F.rand(1) * 4 - 2).alias("x"), (F.rand(2) * 4 - 2).alias("y"))
    q, r = bins.hex_cell(F.col("x"), F.col("y"), 0.3)
    d = d.withColumns({"q": q, "r": r})
    cx, cy = 0.3 * 1.5 * F.col("q"), 0.3 * math.sqrt(3) * (F.col("r") + F.col("q") / 2)
    assert d.select(F.max(F.hypot(F.col("x") - cx, F.col("y") - cy))).first()[0] <= 0.3 + 1e-9


def test_stratified_split_keeps_shares(spark):
    d = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = lr.stratified_split(d, "id", "y", 0.2).groupBy("y").agg(F.count_if("is_test").alias("n")).collect()
    assert {r["y"]: r["n"] for r in s} == {0: 180, 1: 20}


def test_special_functions_run_over_batches(spark):
    """The loops of the series ran step by step in interpreted lambdas, some thousand for a row."""
    d = spark.createDataFrame([(x,) for x in (None, float("nan"), float("inf"), -4.0, -2.5, -0.3, 0.0, 0.7, 2.5, 6.0)], "x double")
    out = d.select("x", special.erf(F.col("x")).alias("e"), special.erfc(F.col("x")).alias("c"), special.erfinv(special.erf(F.col("x") / 4)).alias("i"), special.norm_ppf(F.col("x")).alias("q"))
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
    rows = out.collect()
    assert rows[0][1:] == (None, None, None, None) and math.isnan(rows[1].e) and rows[1].i is None and rows[1].q is None and (rows[2].e, rows[2].c, rows[2].i) == (1.0, 0.0, None)
    for r in rows[3:]:
        assert r.e == pytest.approx(math.erf(r.x), abs=1e-14) and r.c == pytest.approx(math.erfc(r.x), rel=1e-9) and r.i == pytest.approx(r.x / 4, abs=1e-9)
        assert (r.q is None) == (not 0 < r.x < 1)


def test_class_weights_without_a_join(spark):
    """A join on the class dealt all rows to as many tasks as there are classes."""
    d = spark.createDataFrame([(i, None if i % 10 == 9 else float(i % 10 < 2)) for i in range(100)], "id int, y double")
    out = lr.balanced_weights(d, "y")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString() and out.columns == ["y", "id", "weight"]
    rows = out.collect()
    assert len(rows) == 90 and {(r.y, round(r.weight, 9)) for r in rows} == {(1.0, round(100 / (3 * 20), 9)), (0.0, round(100 / (3 * 70), 9))}


def test_stratified_split_without_a_join_on_the_class(spark):
    """The join left rows in two of all partitions, and every job of a fit visited the others too."""
    d = spark.createDataFrame([(i, None if i % 10 == 9 else float(i % 10 < 2)) for i in range(1000)], "id long, y double")
    s = lr.stratified_split(d, "id", "y", 0.25)
    joins = [line for line in s._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert all("_slice" in j for j in joins) and s.columns == ["y", "id", "is_test"]  # only the positions are joined
    assert {tuple(r) for r in s.groupBy("y").agg(F.count(F.lit(1)), F.count_if("is_test")).collect()} == {(1.0, 200, 50), (0.0, 700, 175)}
