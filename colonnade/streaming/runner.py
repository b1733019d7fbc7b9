"""Structured Streaming over the event table, run to completion into a table in the shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.session import scratch_path
from colonnade.tables import SCHEMAS

LATENESS = "1 hour"


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a stream, with the time column as an instant and a watermark."""
    # a one-name glob stands for a single file as well as for a folder of part files
    files = spark.readStream.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parque[t]")
    return files.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", LATENESS)


def run_append(stream: DataFrame, name: str) -> DataFrame:
    """Append finished rows to parquet until the source is drained; return the table."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)
    q = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{out}_state")
        .trigger(availableNow=True).start(out)
    )
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def run_update(stream: DataFrame, name: str, keys: list[str], version: str) -> DataFrame:
    """Write every change with its batch number; the newest row per key is the state."""
    spark = stream.sparkSession
    out = scratch_path(spark, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the batch number is part of the path, so a replayed batch overwrites itself
        batch.withColumn(version, F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/part={batch_id}")

    q = stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}_state").trigger(availableNow=True).start()
    q.awaitTermination()
    changes = spark.read.parquet(f"{out}/part=*")
    values = [c for c in stream.columns if c not in keys]
    newest = changes.groupBy(*keys).agg(F.max_by(F.struct(*values), version).alias("v"))
    return newest.select(*keys, "v.*")
