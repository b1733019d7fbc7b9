"""Concatenation and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.operators.ordered import with_position
from colonnade.operators.relational import union_all
from colonnade.registry import query


def _acct(t):
    c = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("bal"))
    s = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("bal"))
    return c, s


_C = "SELECT c_custkey AS key, c_nationkey AS nation, c_acctbal AS bal FROM customer"
_S = "SELECT s_suppkey AS key, s_nationkey AS nation, s_acctbal AS bal FROM supplier"


@query("concat_rows", f"{_C} UNION ALL {_S}")
def concat_rows(t):
    return union_all(_acct(t))


@query(
    "concat_columns",
    f"SELECT coalesce(a.key, b.key) AS key, a.bal AS c_bal, b.bal AS s_bal FROM ({_C}) a FULL JOIN ({_S}) b ON a.key = b.key",
)
def concat_columns(t):
    c, s = _acct(t)
    return c.select("key", F.col("bal").alias("c_bal")).join(s.select("key", F.col("bal").alias("s_bal")), "key", "full")


@query(
    "concat_ignore_index",
    f"SELECT row_number() OVER (ORDER BY src, key) - 1 AS idx, bal FROM (SELECT 0 AS src, * FROM ({_C}) UNION ALL SELECT 1, * FROM ({_S}))",
)
def concat_ignore_index(t):
    parts = [d.withColumn("src", F.lit(i)) for i, d in enumerate(_acct(t))]
    return with_position(union_all(parts), ["src", "key"], "idx").select("idx", "bal")


@query("concat_keys", f"SELECT 'x' AS src, * FROM ({_C}) UNION ALL SELECT 'y', * FROM ({_S})")
def concat_keys(t):
    return union_all([d.withColumn("src", F.lit(k)) for k, d in zip("xy", _acct(t))])


_CN = "SELECT c_custkey AS key, c_acctbal AS bal, c_mktsegment AS segment FROM customer"
_SN = "SELECT s_suppkey AS key, s_acctbal AS bal, s_name AS name FROM supplier"


def _unlike(t):
    c = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("segment"))
    s = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("bal"), F.col("s_name").alias("name"))
    return c, s


@query("concat_outer_schema", f"{_CN} UNION ALL BY NAME {_SN}")
def concat_outer_schema(t):
    return union_all(_unlike(t), allow_missing=True)


@query("concat_inner_schema", "SELECT c_custkey AS key, c_acctbal AS bal FROM customer UNION ALL SELECT s_suppkey, s_acctbal FROM supplier")
def concat_inner_schema(t):
    parts = _unlike(t)
    common = [c for c in parts[0].columns if c in parts[1].columns]
    return union_all([p.select(*common) for p in parts])


@query(
    "concat_left_schema",
    "SELECT c_custkey AS key, c_acctbal AS bal, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier",
)
def concat_left_schema(t):
    c, s = _unlike(t)
    kept = [F.col(n) if n in s.columns else F.lit(None).cast(c.schema[n].dataType).alias(n) for n in c.columns]
    return c.unionByName(s.select(*kept))


_A = "SELECT l_partkey AS k FROM lineitem WHERE l_returnflag = 'A'"
_B = "SELECT l_partkey AS k FROM lineitem WHERE l_discount = 0.1"


def _ab(t):
    k = F.col("l_partkey").alias("k")
    return t.lineitem.filter("l_returnflag = 'A'").select(k), t.lineitem.filter("l_discount = 0.1").select(k)


@query("set_union", f"{_A} UNION {_B}")
def set_union(t):
    a, b = _ab(t)
    return a.union(b).distinct()


@query("set_intersect", f"{_A} INTERSECT {_B}")
def set_intersect(t):
    a, b = _ab(t)
    return a.intersect(b)


@query("set_difference", f"{_A} EXCEPT {_B}")
def set_difference(t):
    a, b = _ab(t)
    return a.subtract(b)


@query("set_symmetric_difference", f"({_A} EXCEPT {_B}) UNION ALL ({_B} EXCEPT {_A})")
def set_symmetric_difference(t):
    # one shuffle: tag the side, keep keys seen on one side only
    a, b = _ab(t)
    tagged = a.withColumn("side", F.lit(1)).union(b.withColumn("side", F.lit(2)))
    return tagged.groupBy("k").agg(F.min("side").alias("lo"), F.max("side").alias("hi")).filter("lo = hi").select("k")


@query(
    "split_at_positions",
    """WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, CASE WHEN pos < n * 3 // 10 THEN 0 WHEN pos < n // 2 THEN 1 ELSE 2 END AS piece FROM p""",
)
def split_at_positions(t):
    d = with_position(t.orders.select("o_orderkey"), ["o_orderkey"])
    n = t.orders.agg(F.count(F.lit(1))).scalar()
    d = d.withColumn("n", n)
    return d.select(
        "o_orderkey", F.when(F.expr("pos < n * 3 div 10"), 0).when(F.expr("pos < n div 2"), 1).otherwise(2).alias("piece")
    )
