"""File sources and sinks. Every read states its schema; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.session import scratch_path


def write_csv(df: DataFrame, name: str, header: bool = True, **options: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", header).options(**options).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, **options: str) -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").options(**options).csv(path)


def write_json_lines(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.json(path)
    return path


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


ELEMENTS = (
    "struct<elements: array<struct<id: bigint, type: string, lat: double, lon: double, "
    "center: struct<lat: double, lon: double>, tags: map<string, string>>>>"
)


def flatten_elements(df: DataFrame, payload: str, tags: list[str]) -> DataFrame:
    """API answers with nested elements as flat rows.

    A position missing on the element is taken from its centre; elements without any are dropped.
    """
    el = df.select(F.explode(F.from_json(payload, ELEMENTS)["elements"]).alias("e"))
    flat = el.select(
        F.col("e.id").alias("osm_id"),
        F.col("e.type").alias("osm_type"),
        F.round(F.coalesce("e.lat", "e.center.lat"), 6).alias("latitude"),
        F.round(F.coalesce("e.lon", "e.center.lon"), 6).alias("longitude"),
        *[F.coalesce(F.try_element_at("e.tags", F.lit(k)), F.lit("")).alias(k) for k in tags],
    )
    return flat.filter("latitude is not null and longitude is not null")


def geojson_features(df: DataFrame, lon: str, lat: str, properties: list[str]) -> DataFrame:
    """One GeoJSON feature per row, as text."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"),
        F.struct(*properties).alias("properties"),
    )
    return df.select(F.to_json(feature).alias("value"))
