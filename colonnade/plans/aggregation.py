"""Aggregation and grouping."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions.bins import floor_bucket
from colonnade.operators.ordered import exact_percentiles
from colonnade.operators.relational import one_row
from colonnade.registry import query

def N():
    return F.count(F.lit(1))


@query(
    "agg_global_basic",
    """SELECT round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean, min(l_extendedprice) AS lo,
       max(l_extendedprice) AS hi, count(*) AS n FROM lineitem""",
)
def agg_global_basic(t):
    p = "l_extendedprice"
    return t.lineitem.agg(
        F.round(F.sum(p), 2).alias("total"), F.round(F.avg(p), 4).alias("mean"), F.min(p).alias("lo"), F.max(p).alias("hi"), N().alias("n")
    )


@query(
    "agg_std_var",
    """SELECT round(stddev_pop(l_quantity), 6) AS sd0, round(stddev_samp(l_quantity), 6) AS sd1, round(var_pop(l_quantity), 6) AS v0,
       round(var_samp(l_quantity), 6) AS v1 FROM lineitem""",
)
def agg_std_var(t):
    q = "l_quantity"
    return t.lineitem.agg(
        F.round(F.stddev_pop(q), 6).alias("sd0"),
        F.round(F.stddev(q), 6).alias("sd1"),
        F.round(F.var_pop(q), 6).alias("v0"),
        F.round(F.variance(q), 6).alias("v1"),
    )


@query(
    "agg_prod",
    "SELECT l_returnflag, round(product(1 + l_discount / 10000), 6) AS growth FROM lineitem GROUP BY 1",
)
def agg_prod(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.product(1 + F.col("l_discount") / 10000), 6).alias("growth"))


@query(
    "agg_percentiles",
    """SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(quantile_cont(l_extendedprice, 0.5), 4) AS q50,
       round(quantile_cont(l_extendedprice, 0.75), 4) AS q75 FROM lineitem""",
)
def agg_percentiles(t):
    q = exact_percentiles(t.lineitem, [], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return q.select(*[F.round(c, 4).alias(c) for c in q.columns])


@query("agg_approx_percentile")
def agg_approx_percentile(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.percentile_approx("l_extendedprice", [0.25, 0.5, 0.75], 10000).alias("q")
    ).select("l_returnflag", *[F.col("q")[i].alias(n) for i, n in enumerate(["q25", "q50", "q75"])])


@query(
    "agg_any_all",
    "SELECT l_suppkey, bool_or(l_quantity > 49) AS any_big, bool_and(l_quantity < 50) AS all_small FROM lineitem GROUP BY 1",
)
def agg_any_all(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.bool_or(F.col("l_quantity") > 49).alias("any_big"), F.bool_and(F.col("l_quantity") < 50).alias("all_small")
    )


@query(
    "agg_count_if",
    "SELECT count_if(l_quantity < 6)::BIGINT AS n_small, count_if(l_discount = 0 AND l_tax > 0.05)::BIGINT AS n_full FROM lineitem",
)
def agg_count_if(t):
    return t.lineitem.agg(
        F.count_if(F.col("l_quantity") < 6).alias("n_small"), F.count_if((F.col("l_discount") == 0) & (F.col("l_tax") > 0.05)).alias("n_full")
    )


@query(
    "agg_argmin_argmax",
    """SELECT arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS dearest, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest FROM orders""",
)
def agg_argmin_argmax(t):
    k = F.col("o_orderkey")
    return t.orders.agg(
        F.max_by(k, F.struct("o_totalprice", (-k).alias("k"))).alias("dearest"),
        F.min_by(k, F.struct("o_totalprice", k)).alias("cheapest"),
    )


@query(
    "agg_first_last",
    """SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price
       FROM orders GROUP BY 1""",
)
def agg_first_last(t):
    when = F.struct("o_orderdate", "o_orderkey")
    return t.orders.groupBy("o_custkey").agg(
        F.min_by("o_totalprice", when).alias("first_price"), F.max_by("o_totalprice", when).alias("last_price")
    )


@query(
    "agg_mad",
    """SELECT l_returnflag, round(avg(abs(l_quantity - m)), 6) AS mad FROM lineitem JOIN
       (SELECT l_returnflag, avg(l_quantity) AS m FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY 1""",
)
def agg_mad(t):
    # group mean by a joined aggregate: a window would put a whole group into one task
    means = t.lineitem.groupBy("l_returnflag").agg(F.avg("l_quantity").alias("m"))
    return t.lineitem.join(means, "l_returnflag").groupBy("l_returnflag").agg(F.round(F.avg(F.abs(F.col("l_quantity") - F.col("m"))), 6).alias("mad"))


@query(
    "agg_nunique",
    "SELECT l_returnflag, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_supp FROM lineitem GROUP BY 1",
)
def agg_nunique(t):
    parts = t.lineitem.select("l_returnflag", "l_partkey").distinct().groupBy("l_returnflag").agg(N().alias("n_parts"))
    supp = t.lineitem.select("l_returnflag", "l_suppkey").distinct().groupBy("l_returnflag").agg(N().alias("n_supp"))
    return parts.join(supp, "l_returnflag")


@query(
    "agg_axis_rows",
    """SELECT vec_id, round(list_max(e), 6) AS hi, round(list_min(e), 6) AS lo, round(list_sum(e) / 64, 6) AS mean
       FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)""",
)
def agg_axis_rows(t):
    e = F.col("embedding").cast("array<double>")
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return t.embeddings.select(
        "vec_id", F.round(F.array_max(e), 6).alias("hi"), F.round(F.array_min(e), 6).alias("lo"), F.round(total / F.size(e), 6).alias("mean")
    )


@query(
    "agg_axis_cols",
    "SELECT min(l_quantity) AS q, min(l_extendedprice) AS p, max(l_discount) AS d, max(l_tax) AS x FROM lineitem",
)
def agg_axis_cols(t):
    lows, highs = {"q": "l_quantity", "p": "l_extendedprice"}, {"d": "l_discount", "x": "l_tax"}
    return t.lineitem.agg(*[F.min(c).alias(a) for a, c in lows.items()], *[F.max(c).alias(a) for a, c in highs.items()])


@query(
    "agg_rowwise_predicates",
    """SELECT vec_id, len(list_filter(embedding, lambda x: x < 0))::INT AS n_neg, len(list_filter(embedding, lambda x: x >= 0.3)) = 0 AS all_small FROM embeddings""",
)
def agg_rowwise_predicates(t):
    return t.embeddings.select(
        "vec_id",
        F.size(F.filter("embedding", lambda x: x < 0)).alias("n_neg"),
        F.forall("embedding", lambda x: x.cast("double") < 0.3).alias("all_small"),
    )


_DESCRIBE_SQL = """count({c})::BIGINT AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS sd, CAST(min({c}) AS DOUBLE) AS lo,
    quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q25, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS q50,
    quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS hi"""


def _describe(c):
    # for columns with few distinct values percentile keeps one small value-count map per group
    q = lambda p: F.percentile(F.col(c).cast("double"), F.lit(p))
    d = lambda x: x.cast("double")
    return [
        F.count(c).alias("n"), F.round(F.avg(c), 6).alias("mean"), F.round(F.stddev(c), 6).alias("sd"), d(F.min(c)).alias("lo"),
        q(0.25).alias("q25"), q(0.5).alias("q50"), q(0.75).alias("q75"), d(F.max(c)).alias("hi"),
    ]


@query(
    "describe",
    "SELECT 'l_quantity' AS col, " + _DESCRIBE_SQL.format(c="l_quantity") + " FROM lineitem UNION ALL SELECT 'l_discount', "
    + _DESCRIBE_SQL.format(c="l_discount") + " FROM lineitem UNION ALL SELECT 'l_linenumber', " + _DESCRIBE_SQL.format(c="l_linenumber") + " FROM lineitem",
)
def describe(t):
    long = t.lineitem.select("l_quantity", "l_discount", F.col("l_linenumber").cast("double").alias("l_linenumber")).unpivot(
        [], ["l_quantity", "l_discount", "l_linenumber"], "col", "v"
    )
    return long.groupBy("col").agg(*_describe("v"))


@query("describe_by_group", "SELECT l_returnflag, " + _DESCRIBE_SQL.format(c="l_quantity") + " FROM lineitem GROUP BY 1")
def describe_by_group(t):
    return t.lineitem.groupBy("l_returnflag").agg(*_describe("l_quantity"))


@query("value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand")
def value_counts(t):
    return t.part.groupBy("p_brand").agg(N().alias("n")).orderBy(F.desc("n"), "p_brand")


@query(
    "count_by_two_keys",
    """SELECT year(o_orderdate)::INT AS y, o_orderpriority, count(*) AS n FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1, 2""",
)
def count_by_two_keys(t):
    span = t.orders.filter("o_orderdate >= timestamp_ntz'1996-01-01' and o_orderdate < timestamp_ntz'2000-01-01'")
    return span.groupBy(F.year("o_orderdate").alias("y"), "o_orderpriority").agg(N().alias("n")).orderBy("y", "o_orderpriority")


@query(
    "class_balance",
    "SELECT label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6)::DOUBLE AS pct FROM embeddings GROUP BY 1",
)
def class_balance(t):
    total = t.embeddings.agg(N()).scalar()
    return t.embeddings.groupBy("label").agg(N().alias("n")).withColumn("pct", F.round(100.0 * F.col("n") / total, 6))


@query("group_sum", "SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1")
def group_sum(t):
    return t.lineitem.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))


@query("group_median", "SELECT l_suppkey, round(median(l_extendedprice), 4) AS med FROM lineitem GROUP BY 1")
def group_median(t):
    return exact_percentiles(t.lineitem, ["l_suppkey"], "l_extendedprice", {"med": 0.5}).withColumn("med", F.round("med", 4))


@query(
    "group_multi_agg",
    "SELECT l_suppkey, min(l_quantity) AS lo, median(l_quantity) AS med, max(l_quantity) AS hi FROM lineitem GROUP BY 1",
)
def group_multi_agg(t):
    q = "l_quantity"  # whole numbers from 1 to 50
    return t.lineitem.groupBy("l_suppkey").agg(F.min(q).alias("lo"), F.median(q).alias("med"), F.max(q).alias("hi"))


@query("group_dict_agg", "SELECT l_suppkey, min(l_quantity) AS q, max(l_discount) AS d FROM lineitem GROUP BY 1")
def group_dict_agg(t):
    spec = {"q": F.min("l_quantity"), "d": F.max("l_discount")}
    return t.lineitem.groupBy("l_suppkey").agg(*[e.alias(a) for a, e in spec.items()])


@query(
    "group_named_agg",
    """SELECT event_type, count(*) AS total, count_if(value > 50)::BIGINT AS hot, count_if(value < 1)::BIGINT AS cold,
       round(100.0 * count_if(value > 50) / count(*), 6)::DOUBLE AS hot_pct FROM events GROUP BY 1""",
)
def group_named_agg(t):
    v = F.col("value")
    return (
        t.events.groupBy("event_type")
        .agg(N().alias("total"), F.count_if(v > 50).alias("hot"), F.count_if(v < 1).alias("cold"))
        .withColumn("hot_pct", F.round(100.0 * F.col("hot") / F.col("total"), 6))
    )


@query(
    "group_filter",
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN
       (SELECT l_suppkey FROM lineitem GROUP BY 1 HAVING stddev_samp(l_quantity) > 14.5)""",
)
def group_filter(t):
    keep = t.lineitem.groupBy("l_suppkey").agg(F.stddev("l_quantity").alias("s")).filter("s > 14.5").select("l_suppkey")
    return t.lineitem.join(keep, "l_suppkey", "left_semi").select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "group_transform_center",
    """SELECT l_orderkey, l_linenumber, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey), 8) AS centred FROM lineitem""",
)
def group_transform_center(t):
    means = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("m"))
    return t.lineitem.join(means, "l_suppkey").select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") - F.col("m"), 8).alias("centred"))


@query(
    "group_apply_norm",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_quantity) OVER (PARTITION BY l_suppkey), 6) AS share FROM lineitem""",
)
def group_apply_norm(t):
    sums = t.lineitem.groupBy("l_suppkey").agg(F.sum("l_quantity").alias("s"))
    return t.lineitem.join(sums, "l_suppkey").select("l_orderkey", "l_linenumber", F.round(F.try_divide("l_extendedprice", "s"), 6).alias("share"))


@query("group_iterate_shapes", "SELECT event_type, count(*) AS n_rows, 6 AS n_cols FROM events GROUP BY 1")
def group_iterate_shapes(t):
    return t.events.groupBy("event_type").agg(N().alias("n_rows")).withColumn("n_cols", F.lit(len(t.events.columns)))


@query(
    "group_by_list_key",
    """SELECT (c_custkey * 13 % 5)::BIGINT AS list_key, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def group_by_list_key(t):
    keys = t.customer.select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") * 13 % 5).alias("list_key"))
    return t.orders.join(keys, "o_custkey").groupBy("list_key").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "group_by_mapping",
    """SELECT CASE WHEN l_returnflag IN ('A', 'R') THEN 'vowelless' ELSE 'other' END AS class, sum(l_quantity) AS q FROM lineitem GROUP BY 1""",
)
def group_by_mapping(t):
    mapping = F.create_map(F.lit("A"), F.lit("vowelless"), F.lit("N"), F.lit("other"), F.lit("R"), F.lit("vowelless"))
    return t.lineitem.groupBy(F.try_element_at(mapping, "l_returnflag").alias("class")).agg(F.sum("l_quantity").alias("q"))


@query("group_by_function", "SELECT lower(p_brand) AS brand, round(avg(p_retailprice), 6) AS price FROM part GROUP BY 1")
def group_by_function(t):
    return t.part.groupBy(F.lower("p_brand").alias("brand")).agg(F.round(F.avg("p_retailprice"), 6).alias("price"))


@query(
    "group_by_multi_derived",
    """SELECT lower(p_type) AS kind, p_size // 10 AS size_band, count(*) AS n FROM part GROUP BY 1, 2""",
)
def group_by_multi_derived(t):
    return t.part.groupBy(F.lower("p_type").alias("kind"), F.floor(F.col("p_size") / 10).cast("int").alias("size_band")).agg(N().alias("n"))


@query(
    "group_by_decade",
    """SELECT * FROM (PIVOT (SELECT o_orderpriority, round(o_totalprice) AS v, 'd' || 10 * (year(o_orderdate) // 10) AS decade FROM orders) ON decade USING coalesce(sum(v), 0)::DOUBLE GROUP BY o_orderpriority)""",
)
def group_by_decade(t):
    decade = F.concat(F.lit("d"), floor_bucket(F.year("o_orderdate"), 10).cast("string"))
    d = t.orders.withColumns({"decade": decade, "v": F.round("o_totalprice")})
    return d.groupBy("o_orderpriority").pivot("decade").agg(F.sum("v")).na.fill(0.0)


@query(
    "group_observed_bins",
    """SELECT CASE WHEN l_quantity <= 10 THEN 'low' WHEN l_quantity <= 25 THEN 'mid' ELSE 'high' END AS band, count(*) AS n,
       round(avg(l_extendedprice), 4) AS mean FROM lineitem WHERE l_quantity > 0 AND l_quantity <= 50 GROUP BY 1""",
)
def group_observed_bins(t):
    from colonnade.functions.bins import cut

    return (
        t.lineitem.withColumn("band", cut("l_quantity", [0, 10, 25, 50], ["low", "mid", "high"]))
        .filter("band is not null")
        .groupBy("band")
        .agg(N().alias("n"), F.round(F.avg("l_extendedprice"), 4).alias("mean"))
    )


@query(
    "group_level_mean",
    """SELECT y, round(avg(v), 4) AS mean FROM (SELECT year(o_orderdate)::INT AS y, o_orderstatus, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2) GROUP BY 1""",
)
def group_level_mean(t):
    levels = t.orders.groupBy(F.year("o_orderdate").alias("y"), "o_orderstatus").agg(F.sum("o_totalprice").alias("v"))
    return levels.groupBy("y").agg(F.round(F.avg("v"), 4).alias("mean"))


@query(
    "rollup_margins",
    """SELECT coalesce(l_returnflag, 'All') AS flag, coalesce(l_linestatus, 'All') AS status, count(*) AS n, round(avg(l_quantity), 6) AS mean
       FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def rollup_margins(t):
    cube = t.lineitem.cube("l_returnflag", "l_linestatus").agg(
        F.grouping("l_returnflag").alias("gf"), F.grouping("l_linestatus").alias("gs"), N().alias("n"), F.round(F.avg("l_quantity"), 6).alias("mean")
    )
    return cube.select(
        F.when(F.col("gf") == 1, "All").otherwise(F.col("l_returnflag")).alias("flag"),
        F.when(F.col("gs") == 1, "All").otherwise(F.col("l_linestatus")).alias("status"),
        "n",
        "mean",
    )


@query(
    "grouping_sets_pairs",
    """SELECT o_orderstatus, o_orderpriority, year(o_orderdate)::INT AS y, count(*) AS n FROM orders
       GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus, y), (y))""",
)
def grouping_sets_pairs(t):
    d = t.orders.withColumn("y", F.year("o_orderdate"))
    s, p, y = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("y")
    return d.groupingSets([[s, p], [s, y], [y]], s, p, y).agg(N().alias("n"))


@query(
    "ufunc_reduce",
    """SELECT l_linenumber, sum(l_quantity) AS added, round(product(1 - l_discount / 1000), 6) AS multiplied FROM lineitem GROUP BY 1""",
)
def ufunc_reduce(t):
    return t.lineitem.groupBy("l_linenumber").agg(
        F.sum("l_quantity").alias("added"), F.round(F.product(1 - F.col("l_discount") / 1000), 6).alias("multiplied")
    )


@query(
    "rate_by_group",
    "SELECT o_orderpriority, round(avg(CASE WHEN o_totalprice > 200000 THEN 1.0 ELSE 0.0 END) * 100, 6)::DOUBLE AS pct FROM orders GROUP BY 1",
)
def rate_by_group(t):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.avg((F.col("o_totalprice") > 200000).cast("double")) * 100, 6).alias("pct"))


@query(
    "percent_within",
    """WITH s AS (SELECT avg(value) AS m, stddev_pop(value) AS d FROM events)
       SELECT round(avg(CASE WHEN abs(value - m) <= d THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS within1, round(avg(CASE WHEN abs(value - m) <= 2 * d THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS within2,
       round(avg(CASE WHEN abs(value - m) <= 3 * d THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS within3 FROM events, s""",
)
def percent_within(t):
    s = one_row(t.events, m=F.avg("value"), d=F.stddev_pop("value"))
    z = t.events.select((F.abs(F.col("value") - s.getField("m"))).alias("dev"), s.getField("d").alias("d"))
    return z.agg(*[F.round(F.avg((F.col("dev") <= k * F.col("d")).cast("double")), 6).alias(f"within{k}") for k in (1, 2, 3)])
