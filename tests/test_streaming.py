"""Streams over a folder of part files, replay of a batch, and late rows."""

from pyspark.sql import functions as F

from colonnade.streaming.runner import event_stream, run_append, run_update
from colonnade.tables import Tables


def _copy(spark, sf_dir, tmp_path, parts):
    t = Tables(spark, sf_dir).events.repartitionByRange(parts, "ts")
    t.write.parquet(str(tmp_path / "events.parquet"))
    return str(tmp_path)


def test_folder_of_part_files(spark, sf_dir, tmp_path):
    d = _copy(spark, sf_dir, tmp_path, 5)
    out = run_append(event_stream(spark, d).select("event_id"), "ids")
    assert out.distinct().count() == Tables(spark, sf_dir).events.count()


def test_update_state_equals_batch(spark, sf_dir, tmp_path):
    d = _copy(spark, sf_dir, tmp_path, 4)
    state = event_stream(spark, d).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    got = {r["event_type"]: r["n"] for r in run_update(state, "state", ["event_type"], "v").collect()}
    want = {r["event_type"]: r["count"] for r in Tables(spark, sf_dir).events.groupBy("event_type").count().collect()}
    assert got == want


def test_duplicates_within_the_watermark_are_dropped(spark, sf_dir, tmp_path):
    e = Tables(spark, sf_dir).events
    e.unionByName(e).repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = run_append(event_stream(spark, str(tmp_path)).dropDuplicatesWithinWatermark(["event_id"]).select("event_id"), "dedup")
    assert out.count() == e.count()
