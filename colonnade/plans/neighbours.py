"""Nearest neighbours and distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.functions import geo
from colonnade.operators import neighbours as nb
from colonnade.operators import sphere, vectors
from colonnade.registry import query

_P = "(SELECT vec_id AS id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"


def knn_sql(k):
    return f"""(SELECT id, rank, neighbour, dist FROM (SELECT a.id AS id, b.id AS neighbour, sqrt((b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y)) AS dist,
        row_number() OVER (PARTITION BY a.id ORDER BY (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y), b.id)::INT AS rank FROM {_P} a JOIN {_P} b ON a.id <> b.id) WHERE rank <= {k})"""


def knn_vectors_sql(k):
    """The nearest in all dimensions."""
    e = "(SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"
    return f"""(SELECT id, neighbour, rank FROM (SELECT a.vec_id AS id, b.vec_id AS neighbour, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id)::INT AS rank
        FROM {e} a JOIN {e} b ON a.vec_id <> b.vec_id) WHERE rank <= {k})"""


def plane(t):
    return F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))


@query(
    "nearest_point_join",
    """WITH c AS (SELECT c_custkey AS id, """ + geo.location_sql("c_custkey") + "  FROM customer), s AS (SELECT s_suppkey AS sid, "
    + geo.location_sql("s_suppkey").replace("AS lat", "AS slat").replace("AS lon", "AS slon") + """ FROM supplier),
       d AS (SELECT id, sid, """ + geo.haversine_sql("lat", "lon", "slat", "slon") + """ AS km FROM c, s)
       SELECT id, arg_min(sid, (round(km, 9), sid)) AS facility, round(min(km), 6) AS km FROM d GROUP BY 1""",
)
def nearest_point_join(t):
    def spots(df, key):
        lat, lon = geo.location(key)
        return df.select(F.col(key).alias("id"), lat.alias("lat"), lon.alias("lon"))

    r = sphere.nearest_facility(spots(t.customer, "c_custkey"), spots(t.supplier, "s_suppkey"))
    return r.withColumn("km", F.round("km", 6))


@query("knn_exact", f"SELECT id, rank, neighbour, round(dist, 8) AS dist FROM {knn_sql(5)}")
def knn_exact(t):
    return nb.knn(t.embeddings, "vec_id", *plane(t), 5).withColumn("dist", F.round("dist", 8))


@query("knn_partial", f"SELECT id, neighbour FROM {knn_sql(3)}")
def knn_partial(t):
    # only membership among the k nearest, no order
    return nb.knn(t.embeddings, "vec_id", *plane(t), 3).select("id", "neighbour")


@query("knn_approx")
def knn_approx(t):
    """Nearly the five nearest in all dimensions, for the stated queries (ids divisible by 20) against every row."""
    return vectors.knn_hyperplanes(t.embeddings, "vec_id", "embedding", 5, F.col("vec_id") % 20 == 0)


_W = """(SELECT vec_id, j::INT AS j, embedding[2 * j + 1]::DOUBLE AS x, embedding[2 * j + 2]::DOUBLE AS y FROM embeddings, (SELECT unnest(range(32)) AS j))"""


def _record_points(t):
    """32 points per record, as an array in the row."""
    e = F.col("embedding").cast("array<double>")
    return F.transform(F.sequence(F.lit(0), F.lit(31)), lambda j: F.struct(j.alias("j"), F.get(e, 2 * j).alias("x"), F.get(e, 2 * j + 1).alias("y")))


@query(
    "pairwise_distance_matrix",
    f"SELECT a.vec_id AS vec_id, a.j AS i, b.j AS j, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS dist FROM {_W} a JOIN {_W} b USING (vec_id)",
)
def pairwise_distance_matrix(t):
    # the matrix of the points inside one record has a fixed size, so the work is linear in the table
    d = t.embeddings.select("vec_id", _record_points(t).alias("pts")).select("vec_id", "pts", F.explode("pts").alias("a"))
    d = d.select("vec_id", "a", F.explode("pts").alias("b"))
    return d.select("vec_id", F.col("a.j").alias("i"), F.col("b.j").alias("j"), F.round(F.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")), 6).alias("dist"))


@query(
    "min_spacing",
    f"""SELECT vec_id, round(avg(m), 6) AS spacing, round(min(m), 6) AS closest FROM (SELECT a.vec_id AS vec_id, a.j, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS m
        FROM {_W} a JOIN {_W} b ON a.vec_id = b.vec_id AND a.j <> b.j GROUP BY 1, 2) GROUP BY 1""",
)
def min_spacing(t):
    return spacing(t).select("vec_id", F.round("spacing", 6).alias("spacing"), F.round("closest", 6).alias("closest"))


def spacing(t):
    """Mean and least distance to the nearest other point of the same record, inside the row."""
    d = t.embeddings.select("vec_id", "label", "embedding", _record_points(t).alias("pts"))
    nearest = F.transform(
        "pts", lambda a: F.array_min(F.transform(F.filter("pts", lambda b: b["j"] != a["j"]), lambda b: F.hypot(a["x"] - b["x"], a["y"] - b["y"])))
    )
    d = d.withColumn("near", nearest)
    return d.select("vec_id", "label", "embedding", (F.aggregate("near", F.lit(0.0), lambda x, y: x + y) / F.size("near")).alias("spacing"), F.array_min("near").alias("closest"))
