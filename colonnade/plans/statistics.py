"""Descriptive and inferential statistics."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.functions import geo, special
from colonnade.operators import stats
from colonnade.operators.kernels import ERROR, gaussian_sums
from colonnade.operators.ordered import exact_percentiles
from colonnade.operators.relational import one_row, union_all
from colonnade.registry import query


def N():
    return F.count(F.lit(1))


@query(
    "stat_five_number",
    """SELECT event_type, min(value) AS lo, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS med, round(quantile_cont(value, 0.75), 6) AS q3, max(value) AS hi,
       round(quantile_cont(value, 0.75) - quantile_cont(value, 0.25), 6) AS iqr FROM events GROUP BY 1""",
)
def stat_five_number(t):
    q = exact_percentiles(t.events, ["event_type"], "value", {"lo": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "hi": 1.0})
    r = lambda c: F.round(c, 6)
    return q.select("event_type", "lo", r("q1").alias("q1"), r("med").alias("med"), r("q3").alias("q3"), "hi", r(F.col("q3") - F.col("q1")).alias("iqr"))


@query(
    "stat_skew_kurt",
    """WITH m AS (SELECT event_type, value, avg(value) OVER (PARTITION BY event_type) AS mu FROM events), s AS (SELECT event_type, avg((value - mu) ** 3) / avg((value - mu) ** 2) ** 1.5 AS sk, avg((value - mu) ** 4) / avg((value - mu) ** 2) ** 2 - 3 AS ku FROM m GROUP BY 1)
       SELECT event_type, round(sk, 6) AS skew, round(ku, 6) AS kurt, CASE WHEN sk > 0.5 THEN 'right' WHEN sk < -0.5 THEN 'left' ELSE 'symmetric' END AS shape FROM s""",
)
def stat_skew_kurt(t):
    d = t.events.groupBy("event_type").agg(F.skewness("value").alias("skew"), F.kurtosis("value").alias("kurt"))
    shape = F.when(F.col("skew") > 0.5, "right").when(F.col("skew") < -0.5, "left").otherwise("symmetric")
    return d.select("event_type", F.round("skew", 6).alias("skew"), F.round("kurt", 6).alias("kurt"), shape.alias("shape"))


@query(
    "stat_compare_eras",
    """WITH o AS (SELECT o_totalprice AS v, year(o_orderdate) <= 1997 AS old FROM orders)
       SELECT o_stat AS stat, round(a, 4) AS old, round(b, 4) AS new, round(b - a, 4) AS change FROM (
       SELECT 'mean' AS o_stat, avg(v) FILTER (old) AS a, avg(v) FILTER (NOT old) AS b FROM o UNION ALL SELECT 'std', stddev_samp(v) FILTER (old), stddev_samp(v) FILTER (NOT old) FROM o
       UNION ALL SELECT 'min', min(v) FILTER (old), min(v) FILTER (NOT old) FROM o UNION ALL SELECT 'max', max(v) FILTER (old), max(v) FILTER (NOT old) FROM o)""",
)
def stat_compare_eras(t):
    v, old = F.col("o_totalprice"), F.year("o_orderdate") <= 1997
    fns = {"mean": F.avg, "std": F.stddev, "min": F.min, "max": F.max}
    wide = t.orders.agg(*[f(F.when(c, v)).alias(f"{n}_{e}") for n, f in fns.items() for e, c in (("old", old), ("new", ~old))])
    rows = F.array(*[F.struct(F.lit(n).alias("stat"), F.col(f"{n}_old").alias("old"), F.col(f"{n}_new").alias("new")) for n in fns])
    d = wide.select(F.inline(rows))
    return d.select("stat", F.round("old", 4).alias("old"), F.round("new", 4).alias("new"), F.round(F.col("new") - F.col("old"), 4).alias("change"))


@query(
    "stat_robust_sigma_clip",
    """WITH q AS (SELECT quantile_cont(value, 0.5) AS mu, 0.74 * (quantile_cont(value, 0.75) - quantile_cont(value, 0.25)) AS sig FROM events)
       SELECT event_id, value FROM events, q WHERE value > mu - 5 * sig AND value < mu + 5 * sig""",
)
def stat_robust_sigma_clip(t):
    q = exact_percentiles(t.events, [], "value", {"lo": 0.25, "mu": 0.5, "hi": 0.75})
    s = q.select(F.struct("mu", (0.74 * (F.col("hi") - F.col("lo"))).alias("sig"))).scalar()
    mu, sig, v = s.getField("mu"), s.getField("sig"), F.col("value")
    return t.events.filter((v > mu - 5 * sig) & (v < mu + 5 * sig)).select("event_id", "value")


@query("stat_corr_pair", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem")
def stat_corr_pair(t):
    return t.lineitem.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@query("stat_corr_matrix", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem" for a in _NUM for b in _NUM))
def stat_corr_matrix(t):
    return stats.moments_corr_long(t.lineitem, _NUM).withColumn("r", F.round("r", 6))


@query(
    "stat_top_corr",
    """WITH c AS (SELECT j, corr(v, y) AS r FROM (SELECT CAST(unnest(range(64)) AS INT) AS j, unnest(embedding)::DOUBLE AS v, (label >= 5)::INT::DOUBLE AS y FROM embeddings) GROUP BY 1)
       SELECT j, round(r, 6) AS r FROM c ORDER BY abs(r) DESC, j LIMIT 5""",
)
def stat_top_corr(t):
    long = t.embeddings.select((F.col("label") >= 5).cast("double").alias("y"), F.posexplode("embedding").alias("j", "v"))
    c = long.groupBy("j").agg(F.corr(F.col("v").cast("double"), "y").alias("r"))
    return c.orderBy(F.desc(F.abs("r")), "j").limit(5).select("j", F.round("r", 6).alias("r"))


@query(
    "stat_group_means_diff",
    """SELECT j, round(avg(v) FILTER (y), 6) AS mean1, round(avg(v) FILTER (NOT y), 6) AS mean0, round(avg(v) FILTER (y) - avg(v) FILTER (NOT y), 6) AS diff FROM
       (SELECT CAST(unnest(range(64)) AS INT) AS j, unnest(embedding)::DOUBLE AS v, label >= 5 AS y FROM embeddings) GROUP BY 1""",
)
def stat_group_means_diff(t):
    long = t.embeddings.select((F.col("label") >= 5).alias("y"), F.posexplode(F.col("embedding").cast("array<double>")).alias("j", "v"))
    m1, m0 = F.avg(F.when(F.col("y"), F.col("v"))), F.avg(F.when(~F.col("y"), F.col("v")))
    return long.groupBy("j").agg(F.round(m1, 6).alias("mean1"), F.round(m0, 6).alias("mean0"), F.round(m1 - m0, 6).alias("diff"))


@query(
    "stat_norm_pdf",
    "WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events) SELECT event_id, round(exp(-0.5 * ((value - m) / d) ** 2) / (d * sqrt(2 * pi())), 10) AS pdf FROM events, s",
)
def stat_norm_pdf(t):
    s = one_row(t.events, m=F.avg("value"), d=F.stddev("value"))
    return t.events.select("event_id", F.round(special.norm_pdf(F.col("value"), s.getField("m"), s.getField("d")), 10).alias("pdf"))


@query(
    "stat_norm_cdf_sf",
    f"""WITH s AS (SELECT avg(value) AS m, stddev_samp(value) AS d FROM events), g AS (SELECT event_type, (max(value) - any_value(m)) / any_value(d) AS z, (avg(value) - any_value(m)) / any_value(d) * 10 AS zm FROM events, s GROUP BY 1)
        SELECT event_type, round(0.5 * (1 + {special.erf_sql('zm / sqrt(2)')}), 8) AS cdf, round(0.5 * (1 - {special.erf_sql('zm / sqrt(2)')}), 8) AS sf, round(0.5 * (1 - {special.erf_sql('z / sqrt(2)')}), 8) AS tail FROM g""",
)
def stat_norm_cdf_sf(t):
    s = t.events.agg(F.avg("value").alias("m"), F.stddev("value").alias("d"))
    g = t.events.groupBy("event_type").agg(F.max("value").alias("hi"), F.avg("value").alias("mean"))
    st = s.select(F.struct("m", "d")).scalar()
    g = g.select("event_type", ((F.col("hi") - st.getField("m")) / st.getField("d")).alias("z"), ((F.col("mean") - st.getField("m")) / st.getField("d") * 10).alias("zm"))
    r = lambda c: F.round(c, 8)
    return g.select("event_type", r(special.norm_cdf(F.col("zm"))).alias("cdf"), r(special.norm_sf(F.col("zm"))).alias("sf"), r(special.norm_sf(F.col("z"))).alias("tail"))


@query(
    "stat_norm_ppf",
    # quantile points of the standard normal distribution, from tables
    """SELECT event_type, round(avg(value) + 1.6448536269514722 * stddev_samp(value), 6) AS p95, round(avg(value) + 1.959963984540054 * stddev_samp(value), 6) AS p975,
       round(avg(value) - 2.3263478740408408 * stddev_samp(value), 6) AS p01 FROM events GROUP BY 1""",
)
def stat_norm_ppf(t):
    g = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev("value").alias("s"))
    return g.select("event_type", *[F.round(F.col("m") + special.norm_ppf(F.lit(p)) * F.col("s"), 6).alias(n) for n, p in (("p95", 0.95), ("p975", 0.975), ("p01", 0.01))])


_T = """(m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2))"""


def _t_sql(keys, src, value, first, second):
    k = f"{keys}, " if keys else ""
    return f"""(SELECT {k} count(*) FILTER ({first}) AS n1, avg({value}) FILTER ({first}) AS m1, var_samp({value}) FILTER ({first}) AS v1,
        count(*) FILTER ({second}) AS n2, avg({value}) FILTER ({second}) AS m2, var_samp({value}) FILTER ({second}) AS v2 FROM {src} {f'GROUP BY {keys}' if keys else ''})"""


@query("stat_ttest_ind", f"SELECT round({_T}, 6) AS t, (n1 + n2 - 2)::BIGINT AS df FROM " + _t_sql("", "orders", "o_totalprice", "year(o_orderdate) >= 1999", "year(o_orderdate) <= 1997"))
def stat_ttest_ind(t):
    y = F.year("o_orderdate")
    return stats.t_test(t.orders, [], F.col("o_totalprice"), y >= 1999, y <= 1997).select(F.round("t", 6).alias("t"), "df")


@query("stat_ttest_pvalue")
def stat_ttest_pvalue(t):
    y = F.year("o_orderdate")
    r = stats.t_test(t.orders, ["o_orderpriority"], F.col("o_totalprice"), y >= 1999, y <= 1997)
    r = stats.with_t_pvalue(r, "t", "df")
    return r.select("o_orderpriority", F.round("t", 6).alias("t"), "df", F.round("p", 8).alias("p"), F.round(F.col("p") / 2, 8).alias("p_one_sided"), stats.stars(F.col("p")).alias("stars"))


@query(
    "stat_ttest_by_group",
    f"SELECT event_type, n1, n2, round({_T}, 6) AS t FROM " + _t_sql("event_type", "events", "value", "day(ts) >= 20", "day(ts) <= 10") + " WHERE n1 > 5 AND n2 > 5",
)
def stat_ttest_by_group(t):
    d = F.dayofmonth("ts")
    return stats.t_test(t.events, ["event_type"], F.col("value"), d >= 20, d <= 10).filter("n1 > 5 and n2 > 5").select("event_type", "n1", "n2", F.round("t", 6).alias("t"))


@query(
    "stat_two_prop_z",
    """WITH s AS (SELECT count(*) FILTER (n AND hot) * 1.0::DOUBLE AS x1, count(*) FILTER (n) * 1.0::DOUBLE AS n1, count(*) FILTER (o AND hot) * 1.0::DOUBLE AS x2, count(*) FILTER (o) * 1.0::DOUBLE AS n2 FROM
       (SELECT day(ts) >= 20 AS n, day(ts) <= 10 AS o, value > 100 AS hot FROM events)), p AS (SELECT *, (x1 + x2) / (n1 + n2) AS pp FROM s)
       SELECT round(x1 / n1, 6) AS p1, round(x2 / n2, 6) AS p2, round((x1 / n1 - x2 / n2) / sqrt(pp * (1 - pp) * (1 / n1 + 1 / n2)), 6) AS z FROM p""",
)
def stat_two_prop_z(t):
    new, old, hot = F.dayofmonth("ts") >= 20, F.dayofmonth("ts") <= 10, F.col("value") > 100
    s = t.events.agg(F.count_if(new & hot).alias("x1"), F.count_if(new).alias("n1"), F.count_if(old & hot).alias("x2"), F.count_if(old).alias("n2"))
    x1, n1, x2, n2 = (F.col(c).cast("double") for c in ("x1", "n1", "x2", "n2"))
    pooled = (x1 + x2) / (n1 + n2)
    z = (x1 / n1 - x2 / n2) / F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n2))
    return s.select(F.round(x1 / n1, 6).alias("p1"), F.round(x2 / n2, 6).alias("p2"), F.round(z, 6).alias("z"))


@query("stat_normality")
def stat_normality(t):
    return stats.shapiro_francia(t.events, "event_id", "value")


_FIT = "round(regr_slope({y}, {x}), 6) AS slope, round(regr_intercept({y}, {x}), 4) AS intercept, round(regr_r2({y}, {x}), 6) AS r2"


@query("stat_linear_fit", "SELECT " + _FIT.format(y="l_extendedprice", x="l_quantity") + " FROM lineitem")
def stat_linear_fit(t):
    a = ("l_extendedprice", "l_quantity")
    return t.lineitem.agg(F.round(F.regr_slope(*a), 6).alias("slope"), F.round(F.regr_intercept(*a), 4).alias("intercept"), F.round(F.regr_r2(*a), 6).alias("r2"))


@query("stat_linear_fit_by_group", "SELECT l_returnflag, " + _FIT.format(y="l_extendedprice", x="l_quantity") + " FROM lineitem GROUP BY 1")
def stat_linear_fit_by_group(t):
    a = ("l_extendedprice", "l_quantity")
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.regr_slope(*a), 6).alias("slope"), F.round(F.regr_intercept(*a), 4).alias("intercept"), F.round(F.regr_r2(*a), 6).alias("r2"))


@query("stat_polyfit")
def stat_polyfit(t):
    x, y = F.col("l_quantity"), F.col("l_extendedprice")
    fit = stats.normal_equations(t.lineitem, x, y, 3)
    return t.lineitem.groupBy(x.alias("x")).agg(F.avg(y).alias("mean_y")).withColumn("fitted", stats.standardised_polynomial(F.col("x"), fit))


@query(
    "stat_residuals",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT l_returnflag, count(*) AS n, round(avg(l_extendedprice - a - b * l_quantity), 4) AS bias, round(stddev_pop(l_extendedprice - a - b * l_quantity), 4) AS sd FROM lineitem, f GROUP BY 1""",
)
def stat_residuals(t):
    f = one_row(t.lineitem, a=F.regr_intercept("l_extendedprice", "l_quantity"), b=F.regr_slope("l_extendedprice", "l_quantity"))
    d = t.lineitem.select("l_returnflag", (F.col("l_extendedprice") - f.getField("a") - f.getField("b") * F.col("l_quantity")).alias("res"))
    return d.groupBy("l_returnflag").agg(N().alias("n"), F.round(F.avg("res"), 4).alias("bias"), F.round(F.stddev_pop("res"), 4).alias("sd"))


@query(
    "stat_ci_pi_band",
    """WITH f AS (SELECT count(*) AS n, avg(l_quantity) AS mx, regr_sxx(l_extendedprice, l_quantity) AS sxx, regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
       r AS (SELECT sqrt(sum((l_extendedprice - a - b * l_quantity) ** 2) / (any_value(n) - 2)) AS s FROM lineitem, f)
       SELECT DISTINCT l_quantity AS x, round(a + b * l_quantity, 4) AS fit, round(2 * s * sqrt(1.0::DOUBLE / n + (l_quantity - mx) ** 2 / sxx), 4) AS ci, round(2 * s * sqrt(1 + 1.0::DOUBLE / n + (l_quantity - mx) ** 2 / sxx), 4) AS pi FROM lineitem, f, r""",
)
def stat_ci_pi_band(t):
    x, y = "l_quantity", "l_extendedprice"
    m = t.lineitem.agg(N().alias("n"), F.avg(x).alias("mx"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"), F.avg(y).alias("my"))
    # residual variance follows from the moments, so the table is read once
    m = m.withColumn("b", F.col("sxy") / F.col("sxx")).withColumn("a", F.col("my") - F.col("b") * F.col("mx"))
    m = m.withColumn("s", F.sqrt((F.col("syy") - F.col("b") * F.col("sxy")) / (F.col("n") - 2)))
    f = m.select(F.struct("n", "mx", "sxx", "a", "b", "s")).scalar()
    g = lambda c: f.getField(c)
    dev = 1 / g("n") + (F.col("x") - g("mx")) * (F.col("x") - g("mx")) / g("sxx")
    xs = t.lineitem.select(F.col(x).alias("x")).distinct()
    return xs.select("x", F.round(g("a") + g("b") * F.col("x"), 4).alias("fit"), F.round(2 * g("s") * F.sqrt(dev), 4).alias("ci"), F.round(2 * g("s") * F.sqrt(1 + dev), 4).alias("pi"))


@query(
    "stat_mean_ci_by_x",
    "SELECT l_quantity AS x, l_returnflag AS g, round(avg(l_extendedprice), 6) AS mean, round(1.96 * stddev_samp(l_extendedprice) / sqrt(count(*)), 4) AS half FROM lineitem GROUP BY 1, 2",
)
def stat_mean_ci_by_x(t):
    v = "l_extendedprice"
    return t.lineitem.groupBy(F.col("l_quantity").alias("x"), F.col("l_returnflag").alias("g")).agg(
        F.round(F.avg(v), 6).alias("mean"), F.round(1.96 * F.stddev(v) / F.sqrt(N()), 4).alias("half")
    )


@query("stat_bootstrap_se")
def stat_bootstrap_se(t):
    """Slope of value on hour with errors from 1,000 refits."""
    (_, slope), (intercept_se, slope_se), refits = stats.little_bootstraps(t.spread("events"), "event_id", [F.lit(1.0), F.hour("ts")], F.col("value"))
    return t.spark.createDataFrame([(refits, slope, slope_se, intercept_se)], "replicates long, slope double, slope_se double, intercept_se double")


@query(
    "stat_bayes_posterior",
    """WITH c AS (SELECT quality, count(*)::DOUBLE AS n, count(*) FILTER (toxic = 1)::DOUBLE AS n_tox FROM labels GROUP BY 1), t AS (SELECT sum(n) AS n, sum(n_tox) AS n_tox FROM c)
       SELECT quality, round(c.n / t.n, 8) AS prior, round(c.n_tox / c.n, 8) AS likelihood, round((c.n / t.n) * (c.n_tox / c.n) / (t.n_tox / t.n), 8) AS posterior FROM c, t""",
)
def stat_bayes_posterior(t):
    c = t.labels.groupBy("quality").agg(N().cast("double").alias("n"), F.count_if(F.col("toxic") == 1).cast("double").alias("n_tox"))
    # a handful of classes: normalise over the aggregated table
    everything = W.partitionBy()
    prior, like = F.col("n") / F.sum("n").over(everything), F.col("n_tox") / F.col("n")
    evidence = F.sum("n_tox").over(everything) / F.sum("n").over(everything)
    return c.select("quality", F.round(prior, 8).alias("prior"), F.round(like, 8).alias("likelihood"), F.round(F.try_divide(prior * like, evidence), 8).alias("posterior"))


_GR = """WITH b AS (SELECT floor(10 * ln(1 + value))::INT AS k, count(*) AS n FROM events GROUP BY 1), c AS (SELECT k, sum(n) OVER (ORDER BY k DESC ROWS UNBOUNDED PRECEDING) AS above FROM b)"""


def gutenberg_richter(t):
    # counts per 0.1 bin first; the reverse running total is over a few dozen bins
    bins_ = t.events.groupBy(F.floor(10 * F.log1p("value")).cast("int").alias("k")).agg(N().alias("n"))
    above = F.sum("n").over(W.orderBy(F.desc("k")).rowsBetween(W.unboundedPreceding, 0))
    return bins_.select("k", above.alias("above"))


@query("stat_gutenberg_richter", f"{_GR} SELECT round(regr_slope(log10(above), k / 10.0::DOUBLE), 6) AS slope, round(-regr_slope(log10(above), k / 10.0::DOUBLE), 6) AS b_value, count(*) AS bins FROM c")
def stat_gutenberg_richter(t):
    c = gutenberg_richter(t)
    slope = F.regr_slope(F.log10("above"), F.col("k") / 10.0)
    return c.agg(F.round(slope, 6).alias("slope"), F.round(-slope, 6).alias("b_value"), N().alias("bins"))


_GRID = [2.5 * i for i in range(41)]


def _kde_sql(src, value, h, kernel="exp(-0.5 * (({g} - {v}) / {h}) ** 2) / sqrt(2 * pi())", keys=""):
    k = kernel.format(g="x", v=value, h=h)
    pre = f"{keys}, " if keys else ""
    return f"SELECT {pre}x, round(avg({k} / {h}), 8) AS density FROM {src}, (SELECT unnest(range(41)) * 2.5::DOUBLE AS x) GROUP BY {pre}x"


@query("stat_kde_1d", _kde_sql("events", "value", 4.0))
def stat_kde_1d(t):
    return stats.kde(t.spread("events"), [], "value", _GRID, 4.0).withColumn("density", F.round("density", 8))


@query("stat_kde_by_group", _kde_sql("events", "value", 4.0, keys="event_type"))
def stat_kde_by_group(t):
    return stats.kde(t.spread("events"), ["event_type"], "value", _GRID, 4.0).withColumn("density", F.round("density", 8))


_G2 = [-0.3 + 0.1 * i for i in range(7)]


@query(
    "stat_kde_2d",
    """WITH p AS (SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), s AS (SELECT count(*) AS n, var_samp(x) AS vx, var_samp(y) AS vy, covar_samp(x, y) AS c FROM p),
       h AS (SELECT *, n ** (-1.0 / 3) AS f FROM s), g AS (SELECT i, j, -0.3 + 0.1 * i::DOUBLE AS gx, -0.3 + 0.1 * j::DOUBLE AS gy FROM (SELECT unnest(range(7)) AS i), (SELECT unnest(range(7)) AS j))
       SELECT i::INT AS i, j::INT AS j, round(avg(exp(-0.5 * (vy * (gx - x) ** 2 - 2 * c * (gx - x) * (gy - y) + vx * (gy - y) ** 2) / (f * (vx * vy - c * c))) / (2 * pi() * f * sqrt(vx * vy - c * c))), 6) AS density FROM p, h, g GROUP BY 1, 2""",
)
def stat_kde_2d(t):
    p = t.embeddings.select(F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    s = p.agg(N().alias("n"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.covar_samp("x", "y").alias("c"))
    s = s.withColumn("f", F.pow("n", F.lit(-1.0 / 3))).select(F.struct("vx", "vy", "c", "f")).scalar()  # bandwidth n^(-1/6), squared
    d = stats.on_grid(p.withColumn("s", s), _G2, _G2)
    vx, vy, c, f = (F.col("s")[n] for n in ("vx", "vy", "c", "f"))
    det = vx * vy - c * c
    dx, dy = F.col("gx") - F.col("x"), F.col("gy") - F.col("y")
    kernel = F.exp(-0.5 * (vy * dx * dx - 2 * c * dx * dy + vx * dy * dy) / (f * det)) / (2 * math.pi * f * F.sqrt(det))
    return d.groupBy("i", "j").agg(F.round(F.avg(kernel), 6).alias("density"))


@query(
    "stat_kde_spherical",
    """WITH p AS (SELECT """ + geo.location_sql("c_custkey") + """ FROM customer), g AS (SELECT i, j, 40 + 0.4::DOUBLE * i AS glat, 28 + 0.4::DOUBLE * j AS glon FROM (SELECT unnest(range(6)) AS i), (SELECT unnest(range(6)) AS j))
       SELECT i::INT AS i, j::INT AS j, round(sum(exp(-0.5 * (""" + geo.haversine_sql("glat", "glon", "lat", "lon") + " / 6371.0 / 0.03) ** 2)), 6) AS weight FROM p, g GROUP BY 1, 2",
)
def stat_kde_spherical(t):
    lat, lon = geo.location("c_custkey")
    p = t.customer.select(lat.alias("lat"), lon.alias("lon"))
    d = stats.on_grid(p, [40 + 0.4 * i for i in range(6)], [28 + 0.4 * j for j in range(6)])
    angle = geo.haversine(F.col("gx"), F.col("gy"), F.col("lat"), F.col("lon")) / geo.EARTH_KM
    return d.groupBy("i", "j").agg(F.round(F.sum(F.exp(-0.5 * (angle / 0.03) * (angle / 0.03))), 6).alias("weight"))


_BW = [0.5, 1.0, 2.0, 4.0]


@query(
    "stat_kde_bandwidth_cv",
    """WITH v AS (SELECT l_quantity AS x, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1), t AS (SELECT sum(n) AS total FROM v), b AS (SELECT unnest([0.5, 1.0, 2.0, 4.0])::DOUBLE AS h),
       d AS (SELECT h, a.x, any_value(a.n) AS n, (sum(c.n * exp(-0.5 * ((a.x - c.x) / h) ** 2)) - 1) / (h * sqrt(2 * pi()) * (any_value(total) - 1)) AS f FROM v a, v c, b, t GROUP BY 1, 2)
       SELECT h, round(sum(n * ln(f)), 2) AS loglik FROM d GROUP BY 1""",
)
def stat_kde_bandwidth_cv(t):
    """Leave-one-out log likelihood per bandwidth; equal values are counted first, the kernel sums run over bins."""
    v = t.hold(t.lineitem.groupBy(F.col("l_quantity").alias("x")).agg(N().cast("double").alias("n")))
    total = v.agg(F.sum("n")).scalar()
    parts = []
    for h in _BW:
        s = gaussian_sums(v.withColumn("c", F.lit(0)), v, h).join(v, "x")
        # a value without any other near it is as likely as the sums are exact
        f = F.greatest(F.col("s") - 1, ERROR * total) / (h * math.sqrt(2 * math.pi) * (total - 1))
        parts.append(s.agg(F.round(F.sum(F.col("n") * F.ln(f)), 2).alias("loglik")).select(F.lit(h).alias("h"), "loglik"))
    return union_all(parts)


@query(
    "stat_accumulate_hours",
    """SELECT count(*) FILTER (value / 10 < 4)::BIGINT AS idle, count(*) FILTER (value / 10 BETWEEN 4 AND 13)::BIGINT AS partial, count(*) FILTER (value / 10 > 13 AND value / 10 <= 25)::BIGINT AS rated,
       count(*) FILTER (value / 10 > 25)::BIGINT AS cutout, round(count(*) FILTER (value / 10 < 4) / count(*), 6) AS idle_share FROM events""",
)
def stat_accumulate_hours(t):
    v = F.col("value") / 10
    return t.events.agg(
        F.count_if(v < geo.CUT_IN).alias("idle"), F.count_if(v.between(geo.CUT_IN, geo.RATED_SPEED)).alias("partial"),
        F.count_if((v > geo.RATED_SPEED) & (v <= geo.CUT_OUT)).alias("rated"), F.count_if(v > geo.CUT_OUT).alias("cutout"),
        F.round(F.count_if(v < geo.CUT_IN) / N(), 6).alias("idle_share"),
    )
