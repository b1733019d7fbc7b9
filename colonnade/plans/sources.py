"""Sources, sinks and generated tables. Files are written by Spark from the given tables and read back."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from colonnade.functions import geo
from colonnade.functions.text import clock_seconds
from colonnade.operators.relational import union_all
from colonnade.registry import query
from colonnade.session import scratch_path
from colonnade.sources import files


@query("read_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def read_csv_header(t):
    path = files.write_csv(t.customer, "customer")
    return files.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")


@query("read_csv_names_na", "SELECT vec_id, CASE WHEN vec_id % 5 = 0 THEN NULL ELSE label END AS label FROM embeddings")
def read_csv_names_na(t):
    raw = t.embeddings.select("vec_id", F.when(F.col("vec_id") % 5 == 0, "?").otherwise(F.col("label").cast("string")))
    path = files.write_csv(raw, "heart", header=False)
    return files.read_csv(t.spark, path, "vec_id bigint, label int", header=False, nullValue="?")


@query("read_csv_ts_index", "SELECT date_trunc('second', ts)::TIMESTAMP AS ts, event_id, value FROM events")
def read_csv_ts_index(t):
    raw = t.events.select(F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("ts"), "event_id", "value")
    path = files.write_csv(raw, "bikes")
    return files.read_csv(t.spark, path, "ts timestamp_ntz, event_id bigint, value double", timestampNTZFormat="dd/MM/yyyy HH:mm:ss")


@query("read_csv_converter", "SELECT event_id, (hour(ts) * 3600 + minute(ts) * 60 + second(ts))::INT AS split FROM events")
def read_csv_converter(t):
    path = files.write_csv(t.events.select("event_id", F.date_format("ts", "HH:mm:ss").alias("split")), "splits")
    raw = files.read_csv(t.spark, path, "event_id bigint, split string")
    return raw.withColumn("split", clock_seconds(F.col("split")))


@query("read_json_lines", "SELECT doc_id, lang, source, n_chars FROM documents")
def read_json_lines(t):
    path = files.write_json_lines(t.documents, "documents")
    return files.read_json_lines(t.spark, path, "doc_id bigint, lang string, source string, n_chars bigint")


@query(
    "flatten_api_json",
    """SELECT s_suppkey AS osm_id, CASE WHEN s_suppkey % 2 = 0 THEN 'node' ELSE 'way' END AS osm_type, round(lat, 6) AS latitude, round(lon, 6) AS longitude, s_name AS name,
       CASE WHEN s_suppkey % 3 = 0 THEN s_nationkey::VARCHAR ELSE '' END AS brand FROM (SELECT *, """ + geo.location_sql("s_suppkey") + " FROM supplier) WHERE s_suppkey % 10 <> 9",
)
def flatten_api_json(t):
    lat, lon = geo.location("s_suppkey")
    k = F.col("s_suppkey")
    tags = F.when(k % 3 == 0, F.create_map(F.lit("name"), "s_name", F.lit("brand"), F.col("s_nationkey").cast("string"))).otherwise(F.create_map(F.lit("name"), "s_name"))
    node, way = (k % 2 == 0) & (k % 10 != 9), (k % 2 == 1) & (k % 10 != 9)
    el = F.struct(
        k.alias("id"), F.when(k % 2 == 0, "node").otherwise("way").alias("type"), F.when(node, lat).alias("lat"), F.when(node, lon).alias("lon"),
        F.when(way, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"), tags.alias("tags"),
    )
    # one answer per supplier, as an API would return it for one cell of the map
    answers = t.supplier.select(F.to_json(F.struct(F.array(el).alias("elements"))).alias("payload"))
    path = scratch_path(t.spark, "answers")
    answers.write.text(path)
    return files.flatten_elements(t.spark.read.text(path), "value", ["name", "brand"])


@query("write_csv", "SELECT p_partkey, p_name, p_retailprice FROM part")
def write_csv(t):
    path = files.write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), "part")
    return files.read_csv(t.spark, path, "p_partkey bigint, p_name string, p_retailprice double")


@query(
    "write_geojson",
    "SELECT 'Feature' AS type, lon, lat, s_name AS name FROM (SELECT s_name, " + geo.location_sql("s_suppkey") + " FROM supplier)",
)
def write_geojson(t):
    lat, lon = geo.location("s_suppkey")
    rows = t.supplier.select(lat.alias("lat"), lon.alias("lon"), F.col("s_name").alias("name"))
    path = scratch_path(t.spark, "stations.geojsonl")
    files.geojson_features(rows, "lon", "lat", ["name"]).write.text(path)
    schema = "type string, geometry struct<type: string, coordinates: array<double>>, properties struct<name: string>"
    back = files.read_json_lines(t.spark, path, schema)
    return back.select("type", F.col("geometry.coordinates")[0].alias("lon"), F.col("geometry.coordinates")[1].alias("lat"), F.col("properties.name").alias("name"))


@query(
    "from_rows",
    "SELECT s_suppkey AS a, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS b, CASE WHEN s_suppkey % 2 = 1 THEN s_acctbal END AS c FROM supplier",
)
def from_rows(t):
    # records with different keys: a missing key is a null column
    even = t.supplier.filter("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("a"), F.col("s_nationkey").alias("b"))
    odd = t.supplier.filter("s_suppkey % 2 = 1").select(F.col("s_suppkey").alias("a"), F.col("s_acctbal").alias("c"))
    return union_all([even, odd], allow_missing=True)


@query(
    "generate_ranges",
    """WITH n AS (SELECT count(*) AS n FROM orders) SELECT i, i * 2 AS arange, i::DOUBLE / (n - 1) AS linspace, 0.0::DOUBLE AS zeros, 1.0::DOUBLE AS ones, 3.14::DOUBLE AS filled FROM n, (SELECT unnest(range((SELECT n FROM n))) AS i)""",
)
def generate_ranges(t):
    n = t.orders.count()
    i = F.col("i")
    return t.spark.range(n).select(
        F.col("id").alias("i")
    ).select("i", (i * 2).alias("arange"), (i.cast("double") / F.lit(max(n - 1, 1))).alias("linspace"), F.lit(0.0).alias("zeros"), F.lit(1.0).alias("ones"), F.lit(3.14).alias("filled"))


@query("generate_identity", "SELECT a.n_nationkey AS i, b.n_nationkey AS j, (a.n_nationkey = b.n_nationkey)::INT AS v FROM nation a, nation b")
def generate_identity(t):
    # nation keys are 0..24 by definition of the table, so the second index is a fixed range
    d = t.nation.select(F.col("n_nationkey").alias("i"), F.explode(F.sequence(F.lit(0), F.lit(24))).alias("j"))
    return d.select("i", "j", (F.col("i") == F.col("j")).cast("int").alias("v"))


@query("generate_random")
def generate_random(t):
    return t.orders.select("o_orderkey", F.rand(42).alias("uniform"), F.randn(43).alias("normal"), F.floor(F.rand(44) * 10).alias("integer"))


@query("generate_correlated")
def generate_correlated(t):
    # Cholesky factor of [[1, 0.8], [0.8, 2]]
    a, b, c = 1.0, 0.8, math.sqrt(2 - 0.64)
    d = t.orders.select("o_orderkey", F.randn(1).alias("z1"), F.randn(2).alias("z2"))
    return d.select("o_orderkey", (F.col("z1") * a).alias("x"), (F.col("z1") * b + F.col("z2") * c).alias("y"))


@query("generate_blobs")
def generate_blobs(t):
    centres = F.array(*[F.struct(F.lit(x).alias("cx"), F.lit(y).alias("cy")) for x, y in ((-5.0, 0.0), (0.0, 5.0), (5.0, 0.0), (0.0, -5.0))])
    d = t.orders.select("o_orderkey", (F.col("o_orderkey") % 4).cast("int").alias("label"), F.randn(1).alias("z1"), F.randn(2).alias("z2"))
    c = F.get(centres, F.col("label"))
    return d.select("o_orderkey", "label", (c["cx"] + F.col("z1") * 0.6).alias("x"), (c["cy"] + F.col("z2") * 0.6).alias("y"))


@query("generate_rings_moons")
def generate_rings_moons(t):
    d = t.orders.select("o_orderkey", (F.col("o_orderkey") % 2).cast("int").alias("label"), (F.rand(3) * 2 * math.pi).alias("a"), F.randn(1).alias("z1"), F.randn(2).alias("z2"))
    r = F.when(F.col("label") == 0, 1.0).otherwise(0.3)
    ring = d.select(F.lit("rings").alias("shape"), "o_orderkey", "label", (r * F.cos("a") + 0.05 * F.col("z1")).alias("x"), (r * F.sin("a") + 0.05 * F.col("z2")).alias("y"))
    half = F.col("a") / 2
    up = F.col("label") == 0
    moon = d.select(
        F.lit("moons").alias("shape"), "o_orderkey", "label", (F.when(up, F.cos(half)).otherwise(1 - F.cos(half)) + 0.05 * F.col("z1")).alias("x"),
        (F.when(up, F.sin(half)).otherwise(0.5 - F.sin(half)) + 0.05 * F.col("z2")).alias("y"),
    )
    return ring.unionByName(moon)


@query("repeat_tile", "SELECT c_custkey, k, chr((65 + k % 3)::INT) AS batch FROM customer, (SELECT unnest(range(6))::INT AS k)")
def repeat_tile(t):
    d = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    return d.select("c_custkey", "k", F.get(F.array(*map(F.lit, "ABC")), F.col("k") % 3).alias("batch"))


@query("generate_labelled_classes")
def generate_labelled_classes(t):
    stable = t.customer.select(F.col("c_custkey").alias("id"), F.lit(0).alias("label"), (8 + 20 * F.rand(1)).alias("spt_n"), (F.randn(2) * 3 + 20).alias("fines"), F.rand(3).alias("pga"))
    failed = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit(1).alias("label"), (2 + 10 * F.rand(4)).alias("spt_n"), (F.randn(5) * 3 + 10).alias("fines"), (0.3 + 0.7 * F.rand(6)).alias("pga"))
    return stable.unionByName(failed)
