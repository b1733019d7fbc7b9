"""Missing data: detection, removal, filling, NaN rules.

The input tables hold no nulls, so these queries plant them by a key modulus, the same
way in Spark and in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.operators.missing import (
    fill_from_neighbours,
    mean_imputed,
    nan_to_null,
    non_null_columns,
    null_counts,
)
from colonnade.operators.relational import union_all
from colonnade.registry import query

_C = """(SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS bal,
     CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey END AS nat, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS seg,
     CAST(NULL AS DOUBLE) AS empty FROM customer)"""


def _customers(t):
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        F.when(k % 7 != 0, F.col("c_acctbal")).alias("bal"),
        F.when(k % 5 != 0, F.col("c_nationkey")).alias("nat"),
        F.when(k % 3 != 0, F.col("c_mktsegment")).alias("seg"),
        F.lit(None).cast("double").alias("empty"),
    )


_E = "(SELECT event_id, user_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events)"


def _events(t):
    return t.events.select("event_id", "user_id", "ts", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("v"))


@query("null_flags", f"SELECT c_custkey, bal IS NULL AS bal_null, seg IS NOT NULL AS seg_ok FROM {_C}")
def null_flags(t):
    return _customers(t).select(
        "c_custkey", (F.col("bal").isNull() | F.isnan("bal")).alias("bal_null"), F.col("seg").isNotNull().alias("seg_ok")
    )


@query(
    "null_any_per_column",
    f"SELECT bool_or(c_custkey IS NULL) AS c_custkey, bool_or(bal IS NULL) AS bal, bool_or(nat IS NULL) AS nat, bool_or(seg IS NULL) AS seg FROM {_C}",
)
def null_any_per_column(t):
    d = _customers(t)
    return d.agg(*[F.bool_or(F.col(c).isNull()).alias(c) for c in ("c_custkey", "bal", "nat", "seg")])


@query(
    "null_count_share",
    " UNION ALL ".join(f"SELECT '{c}' AS col, count_if({c} IS NULL)::BIGINT AS n_null, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS share FROM {_C}" for c in ("bal", "nat", "seg")),
)
def null_count_share(t):
    return null_counts(_customers(t), ["bal", "nat", "seg"])


@query(
    "null_profile_by_group",
    f"""SELECT year(d)::INT AS y, min(d) AS first_d, max(d) AS last_d, count(*) AS n, count_if(v IS NULL)::BIGINT AS missing FROM
        (SELECT o_orderdate AS d, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS v FROM orders) GROUP BY 1""",
)
def null_profile_by_group(t):
    d = t.orders.select(F.col("o_orderdate").alias("d"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice")).alias("v"))
    return d.groupBy(F.year("d").alias("y")).agg(
        F.min("d").alias("first_d"), F.max("d").alias("last_d"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("v").isNull()).alias("missing")
    )


@query("dropna_any", f"SELECT c_custkey, bal, nat, seg FROM {_C} WHERE bal IS NOT NULL AND nat IS NOT NULL AND seg IS NOT NULL")
def dropna_any(t):
    return _customers(t).drop("empty").na.drop("any")


@query("dropna_subset", f"SELECT c_custkey, bal, nat FROM {_C} WHERE bal IS NOT NULL AND nat IS NOT NULL")
def dropna_subset(t):
    return _customers(t).na.drop(subset=["bal", "nat"]).select("c_custkey", "bal", "nat")


@query(
    "dropna_thresh",
    f"SELECT c_custkey, bal, nat, seg FROM {_C} WHERE (bal IS NOT NULL)::INT + (nat IS NOT NULL)::INT + (seg IS NOT NULL)::INT >= 2",
)
def dropna_thresh(t):
    return _customers(t).na.drop(thresh=2, subset=["bal", "nat", "seg"]).drop("empty")


@query("dropna_columns", f"SELECT c_custkey, bal, nat, seg FROM {_C}")
def dropna_columns(t):
    return non_null_columns(_customers(t), how="all")


@query("fillna_value", f"SELECT c_custkey, coalesce(bal, 0) AS bal, coalesce(seg, 'none') AS seg FROM {_C}")
def fillna_value(t):
    return _customers(t).na.fill({"bal": 0.0, "seg": "none"}).select("c_custkey", "bal", "seg")


@query(
    "fillna_ffill",
    f"SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS v FROM {_E}",
)
def fillna_ffill(t):
    return fill_from_neighbours(_events(t), ["user_id"], ["ts", "event_id"], "v").select("event_id", "v")


@query(
    "fillna_bfill",
    f"SELECT event_id, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS v FROM {_E}",
)
def fillna_bfill(t):
    return fill_from_neighbours(_events(t), ["user_id"], ["ts", "event_id"], "v", backward=True).select("event_id", "v")


@query(
    "fillna_rowwise",
    f"SELECT c_custkey, c_custkey::DOUBLE AS a, coalesce(nat, c_custkey)::DOUBLE AS b, coalesce(bal, nat, c_custkey)::DOUBLE AS c FROM {_C}",
)
def fillna_rowwise(t):
    cols = ["c_custkey", "nat", "bal"]
    filled = [F.coalesce(*[F.col(c).cast("double") for c in reversed(cols[: i + 1])]) for i in range(len(cols))]
    return _customers(t).select("c_custkey", *[e.alias(n) for n, e in zip("abc", filled)])


@query(
    "nan_aggregates",
    """SELECT event_type, round(sum(value) FILTER (event_id % 11 <> 0), 2) AS nansum, min(value) FILTER (event_id % 11 <> 0) AS nanmin,
       max(value) FILTER (event_id % 11 <> 0) AS nanmax, isnan(sum(CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE ELSE value END)) AS plain_sum_is_nan FROM events GROUP BY 1""",
)
def nan_aggregates(t):
    d = t.events.withColumn("v", F.when(F.col("event_id") % 11 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    clean = nan_to_null(F.col("v"))
    return d.groupBy("event_type").agg(
        F.round(F.sum(clean), 2).alias("nansum"), F.min(clean).alias("nanmin"), F.max(clean).alias("nanmax"),
        F.isnan(F.sum("v")).alias("plain_sum_is_nan"),
    )


@query("nullable_int", f"SELECT nat, count(*) AS n, CAST(sum(nat) AS BIGINT) AS s FROM {_C} GROUP BY nat")
def nullable_int(t):
    return _customers(t).groupBy("nat").agg(F.count(F.lit(1)).alias("n"), F.sum("nat").alias("s"))


@query(
    "impute_mean",
    f"SELECT c_custkey, round(coalesce(bal, avg(bal) OVER ()), 6) AS bal, round(coalesce(nat, avg(nat) OVER ()), 6)::DOUBLE AS nat FROM {_C}",
)
def impute_mean(t):
    d = mean_imputed(_customers(t), ["bal", "nat"])
    return d.select("c_custkey", F.round("bal", 6).alias("bal"), F.round("nat", 6).alias("nat"))


@query(
    "arith_fill_value",
    """WITH a AS (SELECT s_nationkey AS k, sum(s_acctbal) AS v FROM supplier WHERE s_acctbal > 5000 GROUP BY 1),
       b AS (SELECT c_nationkey AS k, sum(c_acctbal) AS v FROM customer WHERE c_acctbal < -500 GROUP BY 1)
       SELECT k, round(coalesce(a.v, 0) + coalesce(b.v, 0), 2) AS total FROM a FULL JOIN b USING (k)""",
)
def arith_fill_value(t):
    a = t.supplier.filter("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.sum("s_acctbal").alias("a"))
    b = t.customer.filter("c_acctbal < -500").groupBy(F.col("c_nationkey").alias("k")).agg(F.sum("c_acctbal").alias("b"))
    zero = F.lit(0.0)
    return a.join(b, "k", "full").select("k", F.round(F.coalesce("a", zero) + F.coalesce("b", zero), 2).alias("total"))
