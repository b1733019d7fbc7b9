"""Streaming forms of the time-series queries. Late rows (over one hour) are dropped; open windows are not emitted."""

from __future__ import annotations

from pyspark.sql import functions as F

from colonnade.registry import query
from colonnade.streaming.runner import event_stream, run_append, run_update

_CLOSED = "(SELECT max(ts) - INTERVAL 1 HOUR FROM events)"


def _window(c="window"):
    return [F.col(f"{c}.start").cast("timestamp_ntz").alias("start"), F.col(f"{c}.end").cast("timestamp_ntz").alias("stop")]


@query(
    "stream_tumbling",
    f"""SELECT * FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS start, (date_trunc('day', ts) + INTERVAL 1 DAY)::TIMESTAMP AS stop, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2, 3)
        WHERE stop <= {_CLOSED}""",
)
def stream_tumbling(t):
    s = event_stream(t.spark, t.path)
    agg = s.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return run_append(agg, "tumbling").select(*_window(), "event_type", "n", F.round("total", 2).alias("total"))


@query(
    "stream_sliding",
    f"""SELECT start, start + INTERVAL 1 HOUR AS stop, count(*) AS n, round(sum(value), 2) AS total FROM
        (SELECT (time_bucket(INTERVAL 15 MINUTE, ts) - k * INTERVAL 15 MINUTE)::TIMESTAMP AS start, value FROM events, (SELECT unnest(range(4)) AS k)) GROUP BY 1 HAVING start + INTERVAL 1 HOUR <= {_CLOSED}""",
)
def stream_sliding(t):
    s = event_stream(t.spark, t.path)
    agg = s.groupBy(F.window("ts", "1 hour", "15 minutes")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return run_append(agg, "sliding").select(*_window(), "n", F.round("total", 2).alias("total"))


@query(
    "stream_session",
    f"""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS brk FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
        s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS stop, count(*) AS n, round(sum(value), 2) AS total FROM s GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""",
)
def stream_session(t):
    s = event_stream(t.spark, t.path)
    agg = s.groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return run_append(agg, "session").select("user_id", *_window("session_window"), "n", F.round("total", 2).alias("total"))


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(t):
    # every event arrives twice; the second copy is dropped while its key is in the state
    s = event_stream(t.spark, t.path)
    twice = s.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return run_append(twice.dropDuplicatesWithinWatermark(["event_id"]).select("event_id", "user_id", "event_type"), "dedup")


@query(
    "stream_static_join",
    """WITH b AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events WHERE day(ts) <= 10 GROUP BY 1) SELECT event_id, round((value - m) / s, 6) AS z FROM events JOIN b USING (event_type)""",
)
def stream_static_join(t):
    base = t.events.filter(F.dayofmonth("ts") <= 10).groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev("value").alias("s"))
    s = event_stream(t.spark, t.path)
    z = s.join(base, "event_type").select("event_id", F.try_divide(F.col("value") - F.col("m"), "s").alias("z"))
    return run_append(z, "static_join").select("event_id", F.round("z", 6).alias("z"))


@query("stream_running_state", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total, max(value) AS hi FROM events GROUP BY 1")
def stream_running_state(t):
    s = event_stream(t.spark, t.path)
    state = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"), F.max("value").alias("hi"))
    return run_update(state, "running", ["user_id"], "batch").withColumn("total", F.round("total", 2))
