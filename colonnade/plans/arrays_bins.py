"""Arrays, maps, JSON fields, binning and histograms."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions import bins
from colonnade.operators.ordered import exact_percentiles
from colonnade.operators.relational import one_row
from colonnade.registry import query

_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def _emb(t):
    return t.embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))


@query(
    "arr_index_slice",
    f"""SELECT vec_id, e[1] AS first, e[-1] AS last, list_sum(e[2:4]) AS mid, list_sum(e[1:64:2]) AS every2, list_reverse(e)[1] AS rev FROM {_E}""",
)
def arr_index_slice(t):
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    d = _emb(t).select(
        "vec_id", F.get("e", F.lit(0)).alias("first"), F.element_at("e", -1).alias("last"), total(F.slice("e", 2, 3)).alias("mid"),
        total(F.filter("e", lambda x, i: i % 2 == 0)).alias("every2"), F.reverse("e")[0].alias("rev"),
    )
    return d


@query(
    "arr_build_edit",
    f"""SELECT vec_id, len(list_append(e, 1.0))::INT AS n_app, len(list_concat(e, e[1:2]))::INT AS n_cat, list_sort(e)[1] AS smallest, list_transform(e, lambda x, i: CASE WHEN i = 1 THEN 100 ELSE x END)[1] AS set0 FROM {_E}""",
)
def arr_build_edit(t):
    return _emb(t).select(
        "vec_id", F.size(F.array_append("e", F.lit(1.0))).alias("n_app"), F.size(F.concat("e", F.slice("e", 1, 2))).alias("n_cat"),
        F.array_sort("e")[0].alias("smallest"), F.transform("e", lambda x, i: F.when(i == 0, F.lit(100.0)).otherwise(x))[0].alias("set0"),
    )


@query(
    "arr_higher_order",
    f"""SELECT vec_id, round(list_sum(list_transform(e, lambda x: x * x)), 6) AS squares, len(list_filter(e, lambda x: x > 0))::INT AS n_pos,
        round(list_sum(list_transform(e, lambda x: CASE WHEN x < 0 THEN -x ELSE x END)), 6) AS l1 FROM {_E}""",
)
def arr_higher_order(t):
    total = lambda a: F.round(F.aggregate(a, F.lit(0.0), lambda x, y: x + y), 6)
    return _emb(t).select(
        "vec_id", total(F.transform("e", lambda x: x * x)).alias("squares"), F.size(F.filter("e", lambda x: x > 0)).alias("n_pos"),
        total(F.transform("e", lambda x: F.when(x < 0, -x).otherwise(x))).alias("l1"),
    )


@query(
    "arr_aggregate",
    f"SELECT vec_id, round(list_sum(e), 6) AS s, round(list_min(e), 6) AS lo, round(list_max(e), 6) AS hi, round(list_avg(e), 6) AS m, round(list_stddev_pop(e), 6) AS sd FROM {_E}",
)
def arr_aggregate(t):
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    d = _emb(t).withColumn("mean", total("e") / F.size("e"))
    var = F.aggregate("e", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) * (x - F.col("mean"))) / F.size("e")
    cols = {"s": total("e"), "lo": F.array_min("e"), "hi": F.array_max("e"), "m": F.col("mean"), "sd": F.sqrt(var)}
    return d.select("vec_id", *[F.round(c, 6).alias(n) for n, c in cols.items()])


@query(
    "map_lookup_update",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <= 3 THEN l_tax ELSE NULL END AS got, 99.0::DOUBLE AS updated, 3 AS n_keys FROM lineitem""",
)
def map_lookup_update(t):
    built = F.map_from_arrays(F.array(F.lit(1), F.lit(2), F.lit(3)), F.array("l_tax", "l_tax", "l_tax"))
    updated = F.map_concat(F.map_filter(built, lambda k, v: k != 2), F.create_map(F.lit(2), F.lit(99.0)))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", F.try_element_at(built, F.col("l_linenumber")).alias("got"), F.try_element_at(updated, F.lit(2)).alias("updated"),
        F.size(updated).alias("n_keys"),
    )


@query(
    "json_field",
    "SELECT event_id, (props->>'$.k')::INT AS k, coalesce(props->>'$.brand', 'none') AS brand FROM events",
)
def json_field(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"), F.coalesce(F.get_json_object("props", "$.brand"), F.lit("none")).alias("brand"))


@query(
    "bin_cut",
    "SELECT event_id, CASE WHEN value > 0 AND value <= 18 THEN '(0, 18]' WHEN value > 18 AND value <= 80 THEN '(18, 80]' END AS band FROM events",
)
def bin_cut(t):
    return t.events.select("event_id", bins.cut("value", [0.0, 18.0, 80.0], ["(0, 18]", "(18, 80]"]).alias("band"))


@query(
    "bin_qcut",
    """WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS a, quantile_cont(o_totalprice, 0.5) AS b, quantile_cont(o_totalprice, 0.75) AS c FROM orders)
       SELECT o_orderkey, CASE WHEN o_totalprice <= a THEN 0 WHEN o_totalprice <= b THEN 1 WHEN o_totalprice <= c THEN 2 ELSE 3 END AS quarter FROM orders, q""",
)
def bin_qcut(t):
    edges = exact_percentiles(t.orders, [], "o_totalprice", {"a": 0.25, "b": 0.5, "c": 0.75}).select(F.struct("a", "b", "c")).scalar()
    p = F.col("o_totalprice")
    e = [edges.getField(n) for n in "abc"]
    return t.orders.select("o_orderkey", F.when(p <= e[0], 0).when(p <= e[1], 1).when(p <= e[2], 2).otherwise(3).alias("quarter"))


@query("bin_floor_decade", "SELECT p_partkey, (10 * (p_size // 10))::INT AS decade FROM part")
def bin_floor_decade(t):
    return t.part.select("p_partkey", bins.floor_bucket(F.col("p_size"), 10).alias("decade"))


def _hist_sql(expr, lo, width, n):
    return f"CASE WHEN floor(({expr} - {lo}) / {width}) BETWEEN 0 AND {n - 1} THEN floor(({expr} - {lo}) / {width})::INT WHEN {expr} = {lo + width * n} THEN {n - 1} END"


@query(
    "hist_1d",
    """WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 30 AS w, count(*) AS n FROM events), b AS (SELECT least(floor((value - lo) / w), 29)::INT AS bin FROM events, s)
       SELECT bin, count(*) AS n, round(count(*) / (any_value(s.n) * any_value(w)), 8) AS density FROM b, s GROUP BY 1""",
)
def hist_1d(t):
    s = one_row(t.events, lo=F.min("value"), hi=F.max("value"), n=F.count(F.lit(1)))
    width = (s.getField("hi") - s.getField("lo")) / 30
    d = t.events.select(F.least(F.floor((F.col("value") - s.getField("lo")) / width), F.lit(29)).cast("int").alias("bin"))
    counts = d.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    return counts.select("bin", "n", F.round(F.col("n") / (s.getField("n") * width), 8).alias("density"))


@query(
    "hist_2d",
    f"SELECT {_hist_sql('l_quantity', 1, 2.45, 20)} AS bx, {_hist_sql('l_extendedprice', 0, 5000, 22)} AS by, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def hist_2d(t):
    bx = bins.hist_bin("l_quantity", F.lit(1), F.lit(2.45), 20)
    by = bins.hist_bin("l_extendedprice", F.lit(0), F.lit(5000), 22)
    return t.lineitem.groupBy(bx.alias("bx"), by.alias("by")).agg(F.count(F.lit(1)).alias("n"))


_HEX = """(SELECT CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END::INT AS q, CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END::INT AS r, v FROM
    (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM
    (SELECT *, floor(q + 0.5) AS rq, floor(r + 0.5) AS rr, floor(s + 0.5) AS rs FROM
    (SELECT *, -q - r AS s FROM (SELECT x * (2.0 / 3.0 / 0.05) AS q, x * (-1.0 / 3.0 / 0.05) + y * (sqrt(3.0) / 3.0 / 0.05) AS r, v FROM
    (SELECT embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS v FROM embeddings)))))) """


def _hexed(t):
    x, y, v = (F.get("embedding", F.lit(i)).cast("double") for i in range(3))
    q, r = bins.hex_cell(x, y, 0.05)
    return t.embeddings.select(q.alias("q"), r.alias("r"), v.alias("v"))


@query("hist_hex", f"SELECT q, r, count(*) AS n FROM {_HEX} GROUP BY 1, 2")
def hist_hex(t):
    return _hexed(t).groupBy("q", "r").agg(F.count(F.lit(1)).alias("n"))


@query(
    "hist_nd",
    f"SELECT {_hist_sql('l_quantity', 0, 10, 5)} AS a, {_hist_sql('l_extendedprice', 0, 25000, 5)} AS b, l_linenumber AS c, count(*) AS n FROM lineitem GROUP BY 1, 2, 3",
)
def hist_nd(t):
    a = bins.hist_bin("l_quantity", F.lit(0), F.lit(10), 5)
    b = bins.hist_bin("l_extendedprice", F.lit(0), F.lit(25000), 5)
    return t.lineitem.groupBy(a.alias("a"), b.alias("b"), F.col("l_linenumber").alias("c")).agg(F.count(F.lit(1)).alias("n"))


@query("hist_hex_agg", f"SELECT q, r, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS sd FROM {_HEX} GROUP BY 1, 2")
def hist_hex_agg(t):
    return _hexed(t).groupBy("q", "r").agg(F.round(F.avg("v"), 6).alias("mean"), F.round(F.stddev_pop("v"), 6).alias("sd"))


@query(
    "hist_by_group",
    "SELECT l_returnflag, l_linestatus, floor(l_extendedprice / 5000)::INT AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2, 3",
)
def hist_by_group(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus", F.floor(F.col("l_extendedprice") / 5000).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "boxplot_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
       f AS (SELECT e.event_type, value, q1, med, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM events e JOIN q USING (event_type))
       SELECT event_type, round(any_value(q1), 6) AS q1, round(any_value(med), 6) AS med, round(any_value(q3), 6) AS q3, min(value) FILTER (value >= lo) AS whisker_lo, max(value) FILTER (value <= hi) AS whisker_hi,
       count(*) FILTER (value < lo OR value > hi) AS outliers FROM f GROUP BY 1""",
)
def boxplot_stats(t):
    q = exact_percentiles(t.events, ["event_type"], "value", {"q1": 0.25, "med": 0.5, "q3": 0.75})
    v, iqr = F.col("value"), F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    return t.events.join(q, "event_type").groupBy("event_type").agg(
        *[F.round(F.first(c), 6).alias(c) for c in ("q1", "med", "q3")], F.min(F.when(v >= lo, v)).alias("whisker_lo"),
        F.max(F.when(v <= hi, v)).alias("whisker_hi"), F.count_if((v < lo) | (v > hi)).alias("outliers"),
    )
