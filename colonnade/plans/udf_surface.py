"""User-defined functions: vectorised scalars, group functions, custom estimators, table functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions import udfs
from colonnade.registry import query


@query("udf_scalar", "SELECT p_partkey, (10 * (p_size // 10))::INT AS decade FROM part")
def udf_scalar(t):
    return t.part.select("p_partkey", udfs.decade_udf()("p_size").alias("decade"))


@query("udf_vectorised", "SELECT l_orderkey, l_linenumber, round(exp(-q / 20) * sin(q / 3 + d), 8) AS z FROM (SELECT *, l_quantity AS q, l_discount AS d FROM lineitem)")
def udf_vectorised(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(udfs.damped_wave_udf()("l_quantity", "l_discount"), 8).alias("z"))


@query(
    "udf_group_agg",
    "SELECT l_suppkey, round(sum(l_quantity ** 3) / sum(l_quantity ** 2), 6) AS v FROM lineitem GROUP BY 1",
)
def udf_group_agg(t):
    """An aggregate of one's own, split into per-task partial sums (Arrow batches) and a final merge.

    A grouped-agg UDF would bring each whole group into one Python worker; partials keep
    the hot group spread out.
    """

    def partial(batches):
        for pdf in batches:
            q = pdf["l_quantity"]
            yield pdf.assign(a=q**3, b=q**2).groupby("l_suppkey", as_index=False)[["a", "b"]].sum()

    parts = t.lineitem.select("l_suppkey", "l_quantity").mapInPandas(partial, "l_suppkey bigint, a double, b double")
    return parts.groupBy("l_suppkey").agg(F.round(F.sum("a") / F.sum("b"), 6).alias("v"))


@query("udf_group_transform", "SELECT l_orderkey, l_linenumber, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_suppkey), 8) AS centred FROM lineitem")
def udf_group_transform(t):
    """Group-wise centring in Arrow batches: the group means are joined, the function sees rows in any batch."""
    means = t.lineitem.groupBy("l_suppkey").agg(F.avg("l_quantity").alias("m"))

    def centre(batches):
        for pdf in batches:
            yield pdf.assign(centred=(pdf["l_quantity"] - pdf["m"]))[["l_orderkey", "l_linenumber", "centred"]]

    d = t.lineitem.join(means, "l_suppkey").select("l_orderkey", "l_linenumber", "l_quantity", "m")
    return d.mapInPandas(centre, "l_orderkey bigint, l_linenumber int, centred double").withColumn("centred", F.round("centred", 8))


@query("udf_custom_transformer")
def udf_custom_transformer(t):
    from colonnade.operators.estimators import GaussianBumps

    model = GaussianBumps(inputCol="value", outputPrefix="bump", count=5).fit(t.events)
    return model.transform(t.events.select("event_id", "value"))


@query(
    "udf_custom_classifier",
    """WITH c AS (SELECT (l_extendedprice > 50000)::INT AS c, l_quantity AS x, count(*) AS k FROM lineitem GROUP BY 1, 2),
       s AS (SELECT q.x AS x, c, sum(k * exp(-0.5 * ((q.x - c.x) / 3) ** 2)) AS s FROM (SELECT DISTINCT x FROM c) q, c GROUP BY 1, 2),
       p AS (SELECT x, arg_max(c, (s, -c)) AS prediction, round(max(s) / sum(s), 6) AS probability FROM s GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_quantity, (l_extendedprice > 50000)::INT AS label, prediction, probability FROM lineitem JOIN p ON l_quantity = x""",
)
def udf_custom_classifier(t):
    from colonnade.operators.estimators import DensityClassifier

    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") > 50000).cast("int").alias("label"))
    model = DensityClassifier(inputCol="l_quantity", labelCol="label", bandwidth=3.0).fit(d)
    return model.transform(d).withColumn("probability", F.round("probability", 6))


@query(
    "udtf_generator",
    """SELECT o_orderkey, start, start + 4 AS stop FROM (SELECT o_orderkey, unnest(range(0, 10 + o_orderkey % 5 - 4 + 1, 2))::INT AS start FROM orders)""",
)
def udtf_generator(t):
    d = t.orders.select("o_orderkey", (F.col("o_orderkey") % 5 + 10).cast("int").alias("n"))
    windows = udfs.windows_udtf()
    return d.lateralJoin(windows(F.col("n").outer(), F.lit(4), F.lit(2))).select("o_orderkey", "start", "stop")
