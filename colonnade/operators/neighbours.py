"""Exact nearest neighbours in the plane without comparing all pairs.

Equal points are merged into one site first, so copies never meet each other. Sorting
the sites along a Z-order curve gives every site real neighbours on both sides, and the
distance to them bounds the search. Sites then meet only through grid cells that the
bounded search box touches; the cell size follows the box, so each box touches a few
cells. Every partner inside the box is kept, which makes the answer exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.operators.ordered import framed
from colonnade.operators.relational import top_rows_per_key

LEVELS = list(range(0, 31, 2))  # cell edge = extent / 2**level
_SLACK = 1 + 1e-9
#: Sites of a cell that one task reads.
CROWD = 4096


def _spread(v: Column) -> Column:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
    return v


def z_order(x: Column, y: Column, x0: float, y0: float, extent: float) -> Column:
    """Place on the Z-order curve of a 65,536-square grid."""
    g = lambda c, o: F.least(F.floor((c - o) / extent * 65536), F.lit(65535)).cast("bigint")
    return _spread(g(x, x0)).bitwiseOR(F.shiftleft(_spread(g(y, y0)), 1))


def _extent(df: DataFrame) -> tuple[float, float, float]:
    b = df.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    if b["x0"] is None:
        return 0.0, 0.0, 1.0
    return b["x0"], b["y0"], (max(b["x1"] - b["x0"], b["y1"] - b["y0"]) or 1.0) * _SLACK


def _cells(c: Column, reach: Column, origin: float, edge: Column) -> Column:
    lo = F.floor((c - reach - origin) / edge).cast("bigint")
    return F.sequence(lo, F.greatest(lo, F.floor((c + reach - origin) / edge).cast("bigint")))


def _by_box(queries: DataFrame, sites: DataFrame, frame: tuple[float, float, float]) -> DataFrame:
    """Pairs whose site lies in a cell touched by the query box (``qx``, ``qy``, ``hx``, ``hy``)."""
    x0, y0, extent = frame
    half = F.greatest("hx", "hy")
    level = F.floor(F.log2(F.lit(extent) / (2 * half)))
    level = F.when(half <= 0, LEVELS[-1]).otherwise(F.least(F.greatest(level, F.lit(0)), F.lit(LEVELS[-1])))
    q = queries.withColumn("level", (2 * F.floor(level / 2)).cast("int"))
    edge = F.lit(extent) / F.pow(F.lit(2.0), "level")
    q = q.withColumn("cx", F.explode(_cells(F.col("qx"), F.col("hx"), x0, edge)))
    q = q.withColumn("cy", F.explode(_cells(F.col("qy"), F.col("hy"), y0, edge)))
    q = q.checkpoint()
    used = sorted(r["level"] for r in q.select("level").distinct().collect())  # at most as many as LEVELS
    s = sites.withColumn("level", F.explode(F.array(*map(F.lit, used)).cast("array<int>")))
    s = s.withColumn("cx", F.floor((F.col("x") - x0) / edge).cast("bigint")).withColumn("cy", F.floor((F.col("y") - y0) / edge).cast("bigint"))
    # a crowded cell is dealt in parts, and the boxes that touch it look into each of them
    cell = ["level", "cx", "cy"]
    crowds = s.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select(*cell, F.ceil(F.col("n") / CROWD).alias("parts"))
    s = s.join(crowds, cell, "left").withColumn("part", F.pmod(F.xxhash64("x", "y"), F.coalesce("parts", F.lit(1)))).drop("parts")
    q = q.join(crowds, cell, "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    inside = (F.abs(F.col("x") - F.col("qx")) <= F.col("hx")) & (F.abs(F.col("y") - F.col("qy")) <= F.col("hy"))
    return q.join(s, [*cell, "part"]).filter(inside).drop(*cell, "part")


def knn(df: DataFrame, id: str, x: Column, y: Column, k: int) -> DataFrame:
    """The ``k`` nearest other rows of every row: ``(id, rank, neighbour, dist)``, ties by id."""
    pts = df.select(F.col(id).alias("id"), x.cast("double").alias("x"), y.cast("double").alias("y"))
    frame = _extent(pts)
    # a site keeps its k + 1 smallest ids: enough to answer for every row on it
    few = top_rows_per_key(pts, ["x", "y"], [F.col("id")], k + 1, "_r")
    sites = few.groupBy("x", "y").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("sid", F.col("ids")[0])

    along = sites.select("sid", "x", "y", z_order(F.col("x"), F.col("y"), *frame).alias("z"))
    near = framed(along, [], ["z", "sid"], k, k, {"near": lambda w, f: F.collect_list(F.struct("x", "y")).over(f)})
    d2 = F.array_sort(F.transform("near", lambda p: (p["x"] - F.col("x")) * (p["x"] - F.col("x")) + (p["y"] - F.col("y")) * (p["y"] - F.col("y"))))
    reach = F.coalesce(F.sqrt(F.get(d2, F.lit(k))), F.lit(2 * frame[2])) * _SLACK
    queries = near.select(F.col("sid").alias("qid"), F.col("x").alias("qx"), F.col("y").alias("qy"), reach.alias("hx"), reach.alias("hy"))

    dx, dy = F.col("x") - F.col("qx"), F.col("y") - F.col("qy")
    pairs = _by_box(queries, sites, frame).select("qid", F.sqrt(dx * dx + dy * dy).alias("dist"), F.explode("ids").alias("neighbour"))
    best = top_rows_per_key(pairs, ["qid"], [F.col("dist"), F.col("neighbour")], k + 1, "_r")
    lists = best.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("dist", "neighbour"))).alias("best"))

    members = pts.join(sites.select("x", "y", F.col("sid").alias("qid")), ["x", "y"]).join(lists, "qid")
    others = F.slice(F.filter("best", lambda b: b["neighbour"] != F.col("id")), 1, k)
    return members.select("id", F.posexplode(others).alias("rank", "b")).select(
        "id", (F.col("rank") + 1).alias("rank"), F.col("b.neighbour").alias("neighbour"), F.col("b.dist").alias("dist")
    )


def vote(neighbours: DataFrame, labels: DataFrame, id: str, label: str) -> DataFrame:
    """Majority label among the neighbours; the smaller label wins a tie."""
    votes = neighbours.join(labels.select(F.col(id).alias("neighbour"), F.col(label).alias("_l")), "neighbour")
    counts = votes.groupBy("id", "_l").agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy("id").agg(F.max_by("_l", F.struct("_n", (-F.col("_l")).alias("t"))).alias("prediction"))
