"""Pivots, stacking and other changes of shape. A pivot finds its columns by one aggregated pass over the values that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions.bins import cut, floor_bucket
from colonnade.operators.ordered import exact_percentiles, with_position
from colonnade.operators.reshape import cells_transposed, indicator_columns, margin_pivot
from colonnade.registry import query



def pivot_sql(source: str, on: str, using: str, by: str) -> str:
    """A pivot over all values of ``on``."""
    return f"SELECT * FROM (PIVOT ({source}) ON {on} USING {using} GROUP BY {by})"


_OC = "orders JOIN customer ON o_custkey = c_custkey"


def _oc(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


@query("pivot_simple", pivot_sql("FROM orders", "o_orderstatus", "round(avg(o_totalprice), 4)", "o_orderpriority"))
def pivot_simple(t):
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus").agg(F.round(F.avg("o_totalprice"), 4))


_BAND = "CASE WHEN c_acctbal <= 0 THEN 'neg' WHEN c_acctbal <= 5000 THEN 'low' ELSE 'high' END AS band"


@query("pivot_multi_index", pivot_sql(f"SELECT c_mktsegment, {_BAND}, o_orderstatus, o_totalprice FROM {_OC}", "o_orderstatus", "round(avg(o_totalprice), 4)", "c_mktsegment, band"))
def pivot_multi_index(t):
    d = _oc(t).withColumn("band", cut("c_acctbal", [float("-inf"), 0, 5000, float("inf")], ["neg", "low", "high"]))
    return d.groupBy("c_mktsegment", "band").pivot("o_orderstatus").agg(F.round(F.avg("o_totalprice"), 4))


@query(
    "pivot_multi_columns",
    pivot_sql("SELECT l_linenumber, l_extendedprice, CASE WHEN l_quantity <= 25 THEN 'lo' ELSE 'hi' END || '_' || l_returnflag AS k FROM lineitem", "k", "round(avg(l_extendedprice), 4)", "l_linenumber"),
)
def pivot_multi_columns(t):
    d = t.lineitem.withColumn("k", F.concat_ws("_", F.when(F.col("l_quantity") <= 25, "lo").otherwise("hi"), "l_returnflag"))
    return d.groupBy("l_linenumber").pivot("k").agg(F.round(F.avg("l_extendedprice"), 4))


@query("pivot_multi_agg", pivot_sql("FROM orders", "o_orderstatus", "count(*) AS n, round(avg(o_totalprice), 4) AS mean", "o_orderpriority"))
def pivot_multi_agg(t):
    p = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean"))
    return p.na.fill(0, [c for c in p.columns if c.endswith("_n")])


@query(
    "pivot_margins",
    pivot_sql(
        """SELECT coalesce(o_orderpriority, 'All') AS o_orderpriority, coalesce(o_orderstatus, 'All') AS c, avg(o_totalprice) AS v FROM orders GROUP BY CUBE (o_orderpriority, o_orderstatus)""",
        "c", "round(any_value(v), 4)", "o_orderpriority",
    ),
)
def pivot_margins(t):
    return margin_pivot(t.orders, "o_orderpriority", "o_orderstatus", lambda: F.round(F.avg("o_totalprice"), 4))


@query(
    "pivot_fill_value",
    pivot_sql(
        "SELECT s_suppkey, l_returnflag, l_quantity FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey AND l_discount > 0.09 AND l_linenumber = 1",
        "l_returnflag", "coalesce(sum(l_quantity), 0)", "s_suppkey",
    ),
)
def pivot_fill_value(t):
    few = t.lineitem.filter("l_discount > 0.09 and l_linenumber = 1").withColumnRenamed("l_suppkey", "s_suppkey")
    p = few.groupBy("s_suppkey").pivot("l_returnflag").agg(F.sum("l_quantity"))
    return t.supplier.select("s_suppkey").join(p, "s_suppkey", "left").na.fill(0.0)


@query("pivot_decade_gender", pivot_sql("SELECT (10 * (year(l_shipdate) // 10))::INT AS decade, l_linestatus, l_quantity FROM lineitem", "l_linestatus", "sum(l_quantity)", "decade"))
def pivot_decade_gender(t):
    return t.lineitem.groupBy(floor_bucket(F.year("l_shipdate"), 10).alias("decade")).pivot("l_linestatus").agg(F.sum("l_quantity"))


@query(
    "pivot_date_parts",
    "SELECT month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS d, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1, 2",
)
def pivot_date_parts(t):
    return t.orders.groupBy(F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")).agg(F.round(F.avg("o_totalprice"), 6).alias("mean"))


@query(
    "pivot_heat_table",
    "WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS d FROM events GROUP BY 1) "
    + pivot_sql("SELECT event_type, hour(ts)::INT AS h, (value - m) / d AS z FROM events JOIN s USING (event_type)", "event_type", "round(avg(z), 6)", "h"),
)
def pivot_heat_table(t):
    s = t.events.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev("value").alias("d"))
    z = t.events.join(s, "event_type").withColumn("z", F.try_divide(F.col("value") - F.col("m"), "d"))
    return z.groupBy(F.hour("ts").alias("h")).pivot("event_type").agg(F.round(F.avg("z"), 6))


@query("unstack", pivot_sql("SELECT n_name, c_mktsegment, count(*) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2", "c_mktsegment", "max(v)", "n_name"))
def unstack(t):
    long = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("v"))
    return long.groupBy("n_name").pivot("c_mktsegment").agg(F.first("v"))


@query(
    "stack",
    """SELECT l_orderkey, l_linenumber, 'l_tax' AS name, l_tax AS v FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem""",
)
def stack(t):
    return t.lineitem.unpivot(["l_orderkey", "l_linenumber"], ["l_tax", "l_discount"], "name", "v")


@query(
    "transpose",
    """SELECT CAST(j AS INT) AS i, vec_id AS j, round(CAST(embedding[j + 1] AS DOUBLE), 6) AS v FROM embeddings, (SELECT unnest(range(64)) AS j)""",
)
def transpose(t):
    return cells_transposed(t.embeddings, "vec_id", "embedding").withColumn("v", F.round("v", 6))


@query(
    "wide_to_long_numbered",
    """SELECT vec_id, CAST(j + 1 AS INT) AS k, round(CAST(embedding[j + 1] AS DOUBLE), 6) AS x, round(CAST(embedding[j + 17] AS DOUBLE), 6) AS y, round(CAST(embedding[j + 33] AS DOUBLE), 6) AS z, round(CAST(embedding[j + 49] AS DOUBLE), 6) AS power
       FROM embeddings, (SELECT unnest(range(16)) AS j)""",
)
def wide_to_long_numbered(t):
    stems = ["x", "y", "z", "power"]
    wide = t.embeddings.select(
        "vec_id", *[F.get("embedding", F.lit(b * 16 + j)).cast("double").alias(f"{n}{j + 1}") for b, n in enumerate(stems) for j in range(16)]
    )
    rows = F.array(*[F.struct(F.lit(k).alias("k"), *[F.round(f"{n}{k}", 6).alias(n) for n in stems]) for k in range(1, 17)])
    return wide.select("vec_id", F.inline(rows))


@query(
    "index_to_column",
    "SELECT l_returnflag, l_linestatus, count(*) AS population FROM lineitem GROUP BY 1, 2",
)
def index_to_column(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("population"))


@query(
    "multiindex_product",
    """WITH b AS (SELECT DISTINCT p_brand FROM part), s AS (SELECT p_brand, p_size, count(*) AS n FROM part GROUP BY 1, 2)
       SELECT b.p_brand, z.p_size, coalesce(n, 0)::BIGINT AS n FROM b, (SELECT unnest(range(1, 51))::INT AS p_size) z
       LEFT JOIN s ON s.p_brand = b.p_brand AND s.p_size = z.p_size""",
)
def multiindex_product(t):
    # the inner level is a fixed range, so the product is an explode of the outer level
    full = t.part.select("p_brand").distinct().withColumn("p_size", F.explode(F.sequence(F.lit(1), F.lit(50))))
    seen = t.part.groupBy("p_brand", "p_size").agg(F.count(F.lit(1)).alias("n"))
    return full.join(seen, ["p_brand", "p_size"], "left").na.fill(0)


@query(
    "multiindex_partial_select",
    """SELECT o_orderstatus, y, v FROM (SELECT o_orderstatus, year(o_orderdate)::INT AS y, count(*) AS v FROM orders GROUP BY 1, 2)
       WHERE o_orderstatus = 'F' OR y = 1998""",
)
def multiindex_partial_select(t):
    d = t.orders.filter("o_orderstatus = 'F' or year(o_orderdate) = 1998")
    return d.groupBy("o_orderstatus", F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("v"))


@query(
    "multiindex_tuple_range",
    """SELECT o_orderstatus, y, v FROM (SELECT o_orderstatus, year(o_orderdate)::INT AS y, count(*) AS v FROM orders GROUP BY 1, 2)
       WHERE (o_orderstatus = 'F' AND y >= 1999) OR (o_orderstatus > 'F' AND o_orderstatus < 'O') OR (o_orderstatus = 'O' AND y <= 1997)""",
)
def multiindex_tuple_range(t):
    key = F.struct("o_orderstatus", "y")
    lo, hi = (F.struct(F.lit(s).alias("o_orderstatus"), F.lit(y).alias("y")) for s, y in (("F", 1999), ("O", 1997)))
    d = t.orders.withColumn("y", F.year("o_orderdate")).filter(key.between(lo, hi))
    return d.groupBy("o_orderstatus", "y").agg(F.count(F.lit(1)).alias("v"))


@query(
    "reshape_array",
    """WITH p AS (SELECT o_totalprice AS v, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS pos FROM orders)
       SELECT CAST(pos // 8 AS BIGINT) AS i, CAST(pos % 8 AS BIGINT) AS j, v FROM p""",
)
def reshape_array(t):
    d = with_position(t.orders.select("o_totalprice", "o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    return d.select(F.floor(F.col("pos") / 8).alias("i"), (F.col("pos") % 8).alias("j"), F.col("o_totalprice").alias("v"))


@query("get_dummies", pivot_sql("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w, 1 AS one FROM part", "w", "coalesce(max(one), 0)::INT", "p_partkey"))
def get_dummies(t):
    words = F.split(F.translate("p_name", " ", "|"), r"\|")
    return indicator_columns(t.part.withColumn("w", words), "w", ["p_partkey"])


@query(
    "one_hot_dict",
    "SELECT * FROM (PIVOT (SELECT c_custkey, c_acctbal, 'seg=' || c_mktsegment AS s, 1 AS one FROM customer) ON s USING coalesce(max(one), 0)::INT GROUP BY c_custkey, c_acctbal)",
)
def one_hot_dict(t):
    d = t.customer.withColumn("seg", F.array(F.concat(F.lit("seg="), "c_mktsegment")))
    return indicator_columns(d, "seg", ["c_custkey", "c_acctbal"])


DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


@query(
    "day_dummies",
    """SELECT CAST(d AS VARCHAR) AS d, n, """ + ", ".join(f"CAST(isodow(d) - 1 = {i} AS DOUBLE) AS {n}" for i, n in enumerate(DAYS))
    + " FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)",
)
def day_dummies(t):
    d = t.events.groupBy(F.to_date("ts").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    return d.select(F.col("d").cast("string").alias("d"), "n", *[(F.weekday("d") == i).cast("double").alias(n) for i, n in enumerate(DAYS)])
