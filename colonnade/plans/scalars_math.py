"""Arithmetic, mathematical functions, matrices and formulas."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from colonnade.functions import geo, special
from colonnade.operators.relational import matrix_cells
from colonnade.registry import query


@query(
    "math_arithmetic",
    """SELECT l_orderkey, l_quantity + 5 AS plus, l_quantity - 5 AS minus, l_quantity * 2 AS times, l_quantity / 2 AS halves, floor(l_quantity / 3)::BIGINT AS floordiv,
       l_quantity - 3 * floor(l_quantity / 3) AS modulo, l_quantity ** 2 AS squared, -l_quantity AS negated, CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS guarded FROM lineitem""",
)
def math_arithmetic(t):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", (q + 5).alias("plus"), (q - 5).alias("minus"), (q * 2).alias("times"), (q / 2).alias("halves"), F.floor(q / 3).alias("floordiv"),
        (q - 3 * F.floor(q / 3)).alias("modulo"), F.pow(q, F.lit(2.0)).alias("squared"), (-q).alias("negated"), F.try_divide("l_tax", "l_discount").alias("guarded"),
    )


@query(
    "math_compound_expr",
    "SELECT l_orderkey, l_linenumber, -l_quantity * l_extendedprice / (l_tax + 1) - l_discount AS a, (l_quantity + l_tax) / (l_linenumber) AS d FROM lineitem",
)
def math_compound_expr(t):
    return t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "-l_quantity * l_extendedprice / (l_tax + 1) - l_discount as a", "(l_quantity + l_tax) / l_linenumber as d"
    )


@query("math_eval_local", "SELECT l_orderkey, l_linenumber, round(l_quantity + (SELECT avg(l_tax) FROM lineitem), 6) AS shifted FROM lineitem")
def math_eval_local(t):
    mean = t.lineitem.agg(F.avg("l_tax")).scalar()
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(F.col("l_quantity") + mean, 6).alias("shifted"))


@query(
    "math_abs",
    "SELECT c_custkey, abs(c_acctbal) AS a, round(sqrt(c_acctbal ** 2 + c_nationkey ** 2), 6) AS modulus FROM customer",
)
def math_abs(t):
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("a"), F.round(F.hypot("c_acctbal", F.col("c_nationkey").cast("double")), 6).alias("modulus"))


@query(
    "math_trig",
    """SELECT DISTINCT p_size, round(sin(x), 8) AS s, round(cos(x), 8) AS c, round(tan(x), 6) AS t, round(asin(y), 8) AS asn, round(acos(y), 8) AS acs, round(atan(x), 8) AS atn,
       round(degrees(x), 6) AS deg, round(radians(p_size), 8) AS rad, round(atan2(x, y), 8) AS at2 FROM (SELECT p_size, p_size / 10.0::DOUBLE AS x, p_size / 50.0::DOUBLE AS y FROM part)""",
)
def math_trig(t):
    x, y = F.col("p_size") / 10.0, F.col("p_size") / 50.0
    in_domain = lambda f: F.when(F.abs(y) <= 1, f(y))
    return t.part.select(
        "p_size", F.round(F.sin(x), 8).alias("s"), F.round(F.cos(x), 8).alias("c"), F.round(F.tan(x), 6).alias("t"), F.round(in_domain(F.asin), 8).alias("asn"),
        F.round(in_domain(F.acos), 8).alias("acs"), F.round(F.atan(x), 8).alias("atn"), F.round(F.degrees(x), 6).alias("deg"),
        F.round(F.radians("p_size"), 8).alias("rad"), F.round(F.atan2(x, y), 8).alias("at2"),
    ).distinct()


@query(
    "math_explog",
    """SELECT l_orderkey, l_linenumber, round(exp(d), 8) AS e, round(pow(2, d), 8) AS e2, round(pow(3, d), 8) AS e3, round(ln(q), 8) AS l, round(log2(q), 8) AS l2, round(log10(q), 8) AS l10,
       round(exp(d) - 1, 8) AS em1, round(ln(1 + d), 8) AS l1p FROM (SELECT *, l_discount AS d, l_quantity AS q FROM lineitem)""",
)
def math_explog(t):
    d, q = F.col("l_discount"), F.col("l_quantity")
    cols = {
        "e": F.exp(d), "e2": F.pow(F.lit(2.0), d), "e3": F.pow(F.lit(3.0), d), "l": F.when(q > 0, F.ln(q)), "l2": F.when(q > 0, F.log2(q)),
        "l10": F.when(q > 0, F.log10(q)), "em1": F.expm1(d), "l1p": F.log1p(d),
    }
    return t.lineitem.select("l_orderkey", "l_linenumber", *[F.round(c, 8).alias(n) for n, c in cols.items()])


@query(
    "math_logaddexp",
    "SELECT l_orderkey, l_linenumber, round(ln(exp(l_discount) + exp(l_quantity / 10)), 8) AS v FROM lineitem",
)
def math_logaddexp(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(special.logaddexp(F.col("l_discount"), F.col("l_quantity") / 10), 8).alias("v"))


@query(
    "math_special",
    f"""SELECT p_partkey, round(lgamma(x), 6) AS lg, round(gamma(y), 6) AS g, round(exp(lgamma(x) + lgamma(y) - lgamma(x + y)), 8) AS b,
        round({special.erf_sql('x - 2.5')}, 6) AS erf, round(1 - {special.erf_sql('x - 2.5')}, 6) AS erfc, round(x / 6, 6) AS erfinv_erf
        FROM (SELECT p_partkey, p_size / 10.0::DOUBLE AS x, 0.5 + p_size / 20.0::DOUBLE AS y FROM part)""",
)
def math_special(t):
    x, y = F.col("p_size") / 10.0, 0.5 + F.col("p_size") / 20.0
    cols = {
        "lg": (special.lgamma(x), 6), "g": (special.gamma(y), 6), "b": (special.beta(x, y), 8), "erf": (special.erf(x - 2.5), 6),
        "erfc": (special.erfc(x - 2.5), 6), "erfinv_erf": (special.erfinv(special.erf(x / 6)), 6),
    }
    return t.spread("part").select("p_partkey", *[F.round(c, d).alias(n) for n, (c, d) in cols.items()])


@query(
    "math_bitwise",
    "SELECT l_orderkey, l_partkey & 59 AS a, l_partkey | 59 AS o, xor(l_partkey, 59) AS x, ~l_partkey AS n, l_partkey << 2 AS sl, l_partkey >> 2 AS sr, bin(l_partkey) AS b FROM lineitem",
)
def math_bitwise(t):
    k = F.col("l_partkey")
    return t.lineitem.select(
        "l_orderkey", k.bitwiseAND(F.lit(59)).alias("a"), k.bitwiseOR(F.lit(59)).alias("o"), k.bitwiseXOR(F.lit(59)).alias("x"), F.bitwise_not(k).alias("n"),
        F.shiftleft(k, 2).alias("sl"), F.shiftright(k, 2).alias("sr"), F.bin(k).alias("b"),
    )


@query("math_rounding", "SELECT o_orderkey, round(sqrt(o_totalprice), 1) AS r1, round(sqrt(o_totalprice)) AS r0, round(o_totalprice, -2) AS rm2 FROM orders")
def math_rounding(t):
    root = F.sqrt("o_totalprice")
    return t.orders.select("o_orderkey", F.round(root, 1).alias("r1"), F.round(root).alias("r0"), F.round("o_totalprice", -2).alias("rm2"))


@query(
    "math_broadcast_rowvec",
    """WITH m AS (SELECT vec_id AS i, CAST(unnest(range(64)) AS INT) AS j, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings), c AS (SELECT j, avg(v) AS mu FROM m GROUP BY 1)
       SELECT i, j, round(v - mu, 8) AS v FROM m JOIN c USING (j)""",
)
def math_broadcast_rowvec(t):
    # means once per column position, subtracted inside the row: no cell-level shuffle of the data
    cells = matrix_cells(t.embeddings, "vec_id", "embedding")
    means = cells.groupBy("j").agg(F.avg("v").alias("mu")).agg(F.array_sort(F.collect_list(F.struct("j", "mu"))).alias("m")).scalar()
    d = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("e"), means.alias("m"))
    centred = F.zip_with("e", "m", lambda v, m: v - m.getField("mu"))
    return d.select(F.col("vec_id").alias("i"), F.posexplode(centred).alias("j", "v")).withColumn("v", F.round("v", 8))


@query(
    "math_broadcast_outer",
    """SELECT n_nationkey AS i, j, n_nationkey * j AS product, n_nationkey + j AS total FROM nation, (SELECT unnest(range(1, 13))::INT AS j)""",
)
def math_broadcast_outer(t):
    d = t.nation.select(F.col("n_nationkey").alias("i"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("j"))
    return d.select("i", "j", (F.col("i") * F.col("j")).alias("product"), (F.col("i") + F.col("j")).alias("total"))


@query(
    "math_align_rowvec_subset",
    """SELECT l_orderkey, l_linenumber, l_quantity - (SELECT min(l_quantity) FROM lineitem) AS l_quantity, CAST(NULL AS DOUBLE) AS l_discount,
       round(l_tax - (SELECT max(l_tax) FROM lineitem), 6) AS l_tax FROM lineitem""",
)
def math_align_rowvec_subset(t):
    half = {"l_quantity": t.lineitem.agg(F.min("l_quantity")).scalar(), "l_tax": t.lineitem.agg(F.max("l_tax")).scalar()}
    minus = lambda c: F.col(c) - half[c] if c in half else F.lit(None).cast("double")
    return t.lineitem.select("l_orderkey", "l_linenumber", minus("l_quantity").alias("l_quantity"), minus("l_discount").alias("l_discount"),
                             F.round(minus("l_tax"), 6).alias("l_tax"))


@query(
    "math_grid_eval",
    """WITH x AS (SELECT DISTINCT p_size / 10.0::DOUBLE AS x FROM part), y AS (SELECT unnest(range(0, 51)) / 10.0::DOUBLE AS y)
       SELECT x, y, round(exp(-x / 20) * sin(x / 3 + y), 8) AS z FROM x, y""",
)
def math_grid_eval(t):
    # a mesh is the distinct x values, each with a fixed range of y steps
    g = t.part.select((F.col("p_size") / 10.0).alias("x")).distinct().select("x", F.explode(F.sequence(F.lit(0), F.lit(50))).alias("k")).select("x", (F.col("k") / 10.0).alias("y"))
    x, y = F.col("x"), F.col("y")
    return g.select("x", "y", F.round(F.exp(-x / 20) * F.sin(x / 3 + y), 8).alias("z"))


@query(
    "matrix_product",
    """WITH m AS (SELECT l_suppkey AS i, l_linenumber AS k, sum(l_quantity) AS a FROM lineitem GROUP BY 1, 2),
       n AS (SELECT l_linenumber AS k, l_returnflag AS j, count(*)::DOUBLE AS b FROM lineitem GROUP BY 1, 2)
       SELECT i, j, sum(a * b) AS v FROM m JOIN n USING (k) GROUP BY 1, 2""",
)
def matrix_product(t):
    m = t.lineitem.groupBy(F.col("l_suppkey").alias("i"), F.col("l_linenumber").alias("k")).agg(F.sum("l_quantity").alias("a"))
    n = t.lineitem.groupBy(F.col("l_linenumber").alias("k"), F.col("l_returnflag").alias("j")).agg(F.count(F.lit(1)).cast("double").alias("b"))
    return m.join(n, "k").groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("v"))


@query(
    "matrix_rotate",
    """SELECT c_custkey, round(lat * cos(radians(20)) - lon * sin(radians(20)), 8) AS x, round(lat * sin(radians(20)) + lon * cos(radians(20)), 8) AS y
       FROM (SELECT c_custkey, """ + geo.location_sql("c_custkey") + " FROM customer)",
)
def matrix_rotate(t):
    a = math.radians(20)
    lat, lon = geo.location("c_custkey")
    c, s = F.lit(math.cos(a)), F.lit(math.sin(a))
    return t.customer.select("c_custkey", F.round(lat * c - lon * s, 8).alias("x"), F.round(lat * s + lon * c, 8).alias("y"))


@query(
    "haversine",
    "SELECT c_custkey, round(" + geo.haversine_sql("lat", "lon", "41.0", "29.0") + ", 6) AS km FROM (SELECT c_custkey, " + geo.location_sql("c_custkey") + " FROM customer)",
)
def haversine(t):
    lat, lon = geo.location("c_custkey")
    return t.customer.select("c_custkey", F.round(geo.haversine(lat, lon, F.lit(41.0), F.lit(29.0)), 6).alias("km"))


@query(
    "euclid_distance",
    """SELECT vec_id, round(sqrt((x2-x1)**2 + (y2-y1)**2), 6) AS dist, round(degrees(atan2(y2-y1, x2-x1)), 4) AS bearing FROM
       (SELECT vec_id, embedding[1]::DOUBLE AS x1, embedding[2]::DOUBLE AS y1, embedding[3]::DOUBLE AS x2, embedding[4]::DOUBLE AS y2 FROM embeddings)""",
)
def euclid_distance(t):
    x1, y1, x2, y2 = (F.get("embedding", F.lit(i)).cast("double") for i in range(4))
    return t.embeddings.select("vec_id", F.round(F.hypot(x2 - x1, y2 - y1), 6).alias("dist"), F.round(F.degrees(F.atan2(y2 - y1, x2 - x1)), 4).alias("bearing"))


@query("piecewise_power_curve", f"SELECT event_id, round({geo.turbine_power_sql('(value / 10)')}, 6) AS kw FROM events")
def piecewise_power_curve(t):
    return t.events.select("event_id", F.round(geo.turbine_power(F.col("value") / 10), 6).alias("kw"))


_DAYLIGHT_SQL = """round(24 / pi() * acos(greatest(-1, least(1, tan(radians(47.61)) * tan(radians(23.44 * cos(date_diff('day', DATE '2000-12-21', {d}) * 2 * pi() / 365.25)))))), 6)"""


@query("daylight_hours", "SELECT CAST(d AS VARCHAR) AS d, " + _DAYLIGHT_SQL.format(d="d") + " AS hours FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def daylight_hours(t):
    d = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(F.col("d").cast("string").alias("d"), F.round(geo.daylight_hours(F.col("d")), 6).alias("hours"))


@query(
    "unit_convert",
    "SELECT o_orderkey, o_totalprice * 4.448 AS kn, o_totalprice / 1000000 AS mw, (10000 * year(o_orderdate) + 100 * month(o_orderdate) + day(o_orderdate))::INT AS ymd FROM orders",
)
def unit_convert(t):
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", (F.col("o_totalprice") * 4.448).alias("kn"), (F.col("o_totalprice") / 1000000).alias("mw"),
        (10000 * F.year(d) + 100 * F.month(d) + F.dayofmonth(d)).alias("ymd"),
    )
