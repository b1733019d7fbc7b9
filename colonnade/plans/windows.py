"""Window and order-based queries.

Three ways are used. Whole tables and keys of any size go through
``operators.ordered``. Series already aggregated to calendar days are bounded by the
calendar, so a plain window is fine. Per-group statistics are joined back.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators.ordered import framed, running, with_position
from colonnade.operators.relational import one_row, top_rows_per_key
from colonnade.operators.timeseries import centred_reach, daily, full_frame, gaussian_rolling
from colonnade.registry import query


@query(
    "cumulative_sum",
    "SELECT o_orderkey, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) OVER (ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM orders",
)
def cumulative_sum(t):
    return running(t.orders, [], ["o_orderdate", "o_orderkey"], {"total": ("sum", F.round("o_totalprice").cast("bigint"))}).select("o_orderkey", "total")


@query(
    "cumulative_product",
    "SELECT event_id, round(exp(sum(ln(1 + value / 100000)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), 8) AS growth FROM events",
)
def cumulative_product(t):
    # a product of positive factors is the exponential of a running sum of logarithms
    d = running(t.events, ["user_id"], ["ts", "event_id"], {"lg": ("sum", F.log1p(F.col("value") / 100000))})
    return d.select("event_id", F.round(F.exp("lg"), 8).alias("growth"))


@query(
    "cumulative_variance_share",
    """WITH v AS (SELECT CAST(j AS INT) AS j, var_samp(v) AS v FROM (SELECT unnest(range(64)) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY 1)
       SELECT j, round(sum(v) OVER (ORDER BY v DESC, j ROWS UNBOUNDED PRECEDING) / sum(v) OVER (), 6) AS share FROM v""",
)
def cumulative_variance_share(t):
    # one row per dimension after the aggregation
    v = t.embeddings.select(F.posexplode("embedding").alias("j", "v")).groupBy("j").agg(F.variance(F.col("v").cast("double")).alias("v"))
    ranked = W.orderBy(F.desc("v"), "j").rowsBetween(W.unboundedPreceding, 0)
    return v.select("j", F.round(F.sum("v").over(ranked) / F.sum("v").over(W.partitionBy()), 6).alias("share"))


_DAILY = "(SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS v FROM orders GROUP BY 1)"


def _rolled(t, width, fn):
    p, f = centred_reach(width)
    d = daily(t.orders, "o_orderdate", F.round(F.sum("o_totalprice"), 2).alias("v"))
    w = W.orderBy("d").rowsBetween(-p, f)
    return d.select(F.col("d").cast("string").alias("d"), full_frame(fn(w), w, width).alias("r"))


def _rolled_sql(width, expr):
    p, f = width - 1 - (width - 1) // 2, (width - 1) // 2
    return f"""SELECT CAST(d AS VARCHAR) AS d, CASE WHEN count(*) OVER w = {width} THEN {expr} END AS r FROM {_DAILY}
        WINDOW w AS (ORDER BY d ROWS BETWEEN {p} PRECEDING AND {f} FOLLOWING)"""


@query("rolling_mean_centered", _rolled_sql(365, "round(avg(v) OVER w, 4)"))
def rolling_mean_centered(t):
    return _rolled(t, 365, lambda w: F.round(F.avg("v").over(w), 4))


@query("rolling_median_centered", _rolled_sql(31, "round(quantile_cont(v, 0.5) OVER w, 4)"))
def rolling_median_centered(t):
    return _rolled(t, 31, lambda w: F.round(F.percentile("v", F.lit(0.5)).over(w), 4))


@query("rolling_std_centered", _rolled_sql(31, "round(stddev_samp(v) OVER w, 4)"))
def rolling_std_centered(t):
    return _rolled(t, 31, lambda w: F.round(F.stddev("v").over(w), 4))


@query("rolling_sum_even_window", _rolled_sql(30, "round(sum(v) OVER w, 2)"))
def rolling_sum_even_window(t):
    return _rolled(t, 30, lambda w: F.round(F.sum("v").over(w), 2))


@query(
    "rolling_gaussian",
    f"""WITH s AS (SELECT d, v, row_number() OVER (ORDER BY d) AS pos FROM {_DAILY}), k AS (SELECT unnest(range(50)) AS k)
        SELECT CAST(a.d AS VARCHAR) AS d, CASE WHEN count(*) = 50 THEN round(sum(b.v * exp(-0.5 * ((k - 24.5) / 10) ** 2)), 4) END AS r
        FROM s a JOIN k ON true LEFT JOIN s b ON b.pos = a.pos - 25 + k WHERE b.pos IS NOT NULL GROUP BY a.d""",
)
def rolling_gaussian(t):
    d = daily(t.orders, "o_orderdate", F.round(F.sum("o_totalprice"), 2).alias("v"))
    return gaussian_rolling(d, "d", "v", 50, 10.0, "r").select(F.col("d").cast("string").alias("d"), F.round("r", 4).alias("r"))


@query("rolling_agg_custom", _rolled_sql(7, "round(max(v) OVER w - min(v) OVER w, 2)"))
def rolling_agg_custom(t):
    return _rolled(t, 7, lambda w: F.round(F.max("v").over(w) - F.min("v").over(w), 2))


@query(
    "rolling_time_range",
    """SELECT CAST(d AS VARCHAR) AS d, round(avg(v) OVER (ORDER BY d RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW), 4) AS r FROM """ + _DAILY,
)
def rolling_time_range(t):
    d = daily(t.orders, "o_orderdate", F.round(F.sum("o_totalprice"), 2).alias("v"))
    w = W.orderBy(F.unix_date("d")).rangeBetween(-6, 0)
    return d.select(F.col("d").cast("string").alias("d"), F.round(F.avg("v").over(w), 4).alias("r"))


@query(
    "shift_rows",
    """SELECT event_id, lag(value, 5) OVER w AS earlier, lead(value, 3) OVER w AS later FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def shift_rows(t):
    d = framed(
        t.events.select("event_id", "user_id", "ts", "value"), ["user_id"], ["ts", "event_id"], 5, 3,
        {"earlier": lambda w, f: F.lag("value", 5).over(w), "later": lambda w, f: F.lead("value", 3).over(w)},
    )
    return d.select("event_id", "earlier", "later")


@query("shift_index", "SELECT o_orderkey, o_orderdate + INTERVAL 900 DAY AS shifted FROM orders")
def shift_index(t):
    return t.orders.select("o_orderkey", (F.col("o_orderdate") + F.expr("interval 900 days")).alias("shifted"))


@query(
    "return_on_investment",
    f"SELECT CAST(d AS VARCHAR) AS d, round(100 * (lead(v, 365) OVER (ORDER BY d) - v) / v, 6) AS roi FROM {_DAILY}",
)
def return_on_investment(t):
    d = daily(t.orders, "o_orderdate", F.round(F.sum("o_totalprice"), 2).alias("v"))
    later = F.lead("v", 365).over(W.orderBy("d"))
    return d.select(F.col("d").cast("string").alias("d"), F.round(F.try_divide(100 * (later - F.col("v")), "v"), 6).alias("roi"))


@query(
    "diff_from_first",
    """WITH f AS (SELECT o_custkey, min(o_orderdate) AS d0, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS v0 FROM orders GROUP BY 1)
       SELECT o_orderkey, date_diff('day', d0, o_orderdate)::INT AS days, round(o_totalprice - v0, 2) AS diff FROM orders JOIN f USING (o_custkey)""",
)
def diff_from_first(t):
    first = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("d0"), F.min_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("v0")
    )
    return t.orders.join(first, "o_custkey").select(
        "o_orderkey", F.datediff("o_orderdate", "d0").alias("days"), F.round(F.col("o_totalprice") - F.col("v0"), 2).alias("diff")
    )


@query("rank_sorted_labels", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS rank FROM orders")
def rank_sorted_labels(t):
    return with_position(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "rank").select("o_orderkey", "rank")


@query(
    "sort_within_rows",
    """SELECT vec_id, round(CAST(list_sort(embedding)[1] AS DOUBLE), 6) AS first, round(CAST(list_sort(embedding)[32] AS DOUBLE), 6) AS middle, round(CAST(list_sort(embedding)[64] AS DOUBLE), 6) AS last FROM embeddings""",
)
def sort_within_rows(t):
    s = F.array_sort(F.col("embedding").cast("array<double>"))
    return t.embeddings.select("vec_id", *[F.round(F.element_at(s, i), 6).alias(n) for i, n in ((1, "first"), (32, "middle"), (64, "last"))])


@query(
    "zscore_global",
    "SELECT event_id, round((value - avg(value) OVER ()) / stddev_samp(value) OVER (), 6) AS z, abs((value - avg(value) OVER ()) / stddev_samp(value) OVER ()) > 2 AS outlier FROM events",
)
def zscore_global(t):
    s = one_row(t.events, m=F.avg("value"), d=F.stddev("value"))
    z = F.try_divide(F.col("value") - s.getField("m"), s.getField("d"))
    return t.events.select("event_id", z.alias("z")).select("event_id", F.round("z", 6).alias("z"), (F.abs("z") > 2).alias("outlier"))


@query(
    "zscore_baseline",
    """WITH b AS (SELECT event_type, hour(ts) AS h, avg(value) AS m, stddev_samp(value) AS s FROM events WHERE day(ts) <= 10 GROUP BY 1, 2)
       SELECT event_id, round((value - m) / s, 6) AS z FROM events e LEFT JOIN b ON e.event_type = b.event_type AND hour(e.ts) = b.h""",
)
def zscore_baseline(t):
    e = t.events.withColumn("h", F.hour("ts"))
    base = e.filter(F.dayofmonth("ts") <= 10).groupBy("event_type", "h").agg(F.avg("value").alias("m"), F.stddev("value").alias("s"))
    return e.join(base, ["event_type", "h"], "left").select("event_id", F.round(F.try_divide(F.col("value") - F.col("m"), "s"), 6).alias("z"))


@query(
    "minmax_normalise",
    "SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 6) AS score FROM customer",
)
def minmax_normalise(t):
    s = one_row(t.customer, lo=F.min("c_acctbal"), hi=F.max("c_acctbal"))
    lo, hi = s.getField("lo"), s.getField("hi")
    return t.customer.select("c_custkey", F.round(F.try_divide(F.col("c_acctbal") - lo, hi - lo), 6).alias("score"))


@query(
    "rank_top_n",
    """SELECT l_suppkey, q, row_number() OVER (ORDER BY q DESC, l_suppkey)::INT AS rank FROM (SELECT l_suppkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1) QUALIFY rank <= 20""",
)
def rank_top_n(t):
    best = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q")).orderBy(F.desc("q"), "l_suppkey").limit(20)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("q"), "l_suppkey")))


@query(
    "top_per_group",
    """SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word)::INT AS rank FROM
       (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1, 2) QUALIFY rank <= 15""",
)
def top_per_group(t):
    words = t.spread("documents").select("lang", F.explode(F.split(F.lower("text"), " ", -1)).alias("word")).filter("word <> ''")
    counts = words.groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    return top_rows_per_key(counts, ["lang"], [F.desc("n"), F.col("word")], 15)


# ---- sorting and top-k


@query("sort_values", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal DESC, s_suppkey")
def sort_values(t):
    return t.supplier.select("s_suppkey", "s_acctbal").orderBy(F.desc_nulls_last("s_acctbal"), "s_suppkey")


@query("sort_index", "SELECT o_custkey, o_orderkey FROM orders ORDER BY 1, 2")
def sort_index(t):
    return t.orders.select("o_custkey", "o_orderkey").orderBy("o_custkey", "o_orderkey")


@query("sort_by_expression", "SELECT p_partkey, p_size / p_retailprice AS ratio FROM part ORDER BY ratio DESC, p_partkey")
def sort_by_expression(t):
    return t.part.select("p_partkey", F.try_divide("p_size", "p_retailprice").alias("ratio")).orderBy(F.desc_nulls_last("ratio"), "p_partkey")


@query(
    "head_tail",
    """SELECT * FROM (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)
       UNION ALL SELECT * FROM (SELECT 'tail', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)""",
)
def head_tail(t):
    d = t.orders.select("o_orderkey", "o_totalprice")
    head = d.orderBy("o_totalprice", "o_orderkey").limit(5).select(F.lit("head").alias("part"), "*")
    tail = d.orderBy(F.desc("o_totalprice"), F.desc("o_orderkey")).limit(5).select(F.lit("tail").alias("part"), "*")
    return head.union(tail)


@query("top_k", "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey)::INT AS rank FROM orders QUALIFY rank <= 5")
def top_k(t):
    order = [F.desc("o_totalprice"), F.col("o_orderkey")]
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(*order).limit(5).withColumn("rank", F.row_number().over(W.orderBy(*order)))


@query("partition_k", "SELECT o_totalprice FROM orders ORDER BY 1 LIMIT 3")
def partition_k(t):
    return t.orders.select("o_totalprice").orderBy("o_totalprice").limit(3)


@query(
    "worst_best_rows",
    """(SELECT 'best' AS kind, o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
       UNION ALL (SELECT 'worst', o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""",
)
def worst_best_rows(t):
    row = F.struct("o_orderkey", "o_custkey", "o_totalprice")
    both = t.orders.agg(
        F.max_by(row, F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"))).alias("best"),
        F.min_by(row, F.struct("o_totalprice", F.col("o_orderkey").alias("k"))).alias("worst"),
    )
    return both.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), *[F.col(k)[c].alias(c) for c in ("o_orderkey", "o_custkey", "o_totalprice")]) for k in ("best", "worst")])))
