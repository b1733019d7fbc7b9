"""Date and time queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators.timeseries import business_year_end, calendar, daily, filled_calendar, last_business_day
from colonnade.registry import query

_s = lambda c, n=None: F.col(c).cast("string").alias(n or c)


@query(
    "dt_parse_formats",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS d FROM orders""",
)
def dt_parse_formats(t):
    d = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "yyyy-MM-dd")).when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "yyyyMMdd"))
        .when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "dd MMM yyyy")).otherwise(F.date_format(d, "yyyy/M/d"))
    )
    # each text form has its own format; a form that does not fit gives null and the next is tried
    parsed = F.coalesce(*[F.try_to_timestamp("s", F.lit(f)) for f in ("yyyy-MM-dd", "yyyyMMdd", "dd MMM yyyy", "yyyy/M/d")])
    return t.orders.select("o_orderkey", text.alias("s")).select("o_orderkey", F.to_date(parsed).cast("string").alias("d"))


@query(
    "dt_from_parts",
    """SELECT o_orderkey, CAST(TRY_CAST(y || '-' || lpad(m::VARCHAR, 2, '0') || '-' || lpad(dd::VARCHAR, 2, '0') AS DATE) AS VARCHAR) AS d FROM
       (SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey % 31 + 1 AS dd FROM orders)""",
)
def dt_from_parts(t):
    # a day that does not exist (30 February) gives null
    parts = F.format_string("%04d-%02d-%02d", F.year("o_orderdate"), F.month("o_orderdate"), F.col("o_orderkey") % 31 + 1)
    return t.orders.select("o_orderkey", parts.try_cast("date").cast("string").alias("d"))


@query("dt_format", "SELECT o_orderkey, strftime(o_orderdate, '%A') AS day, strftime(o_orderdate, '%B %Y') AS month FROM orders")
def dt_format(t):
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("day"), F.date_format("o_orderdate", "MMMM yyyy").alias("month"))


@query(
    "dt_parts",
    """SELECT event_id, year(ts)::INT AS y, month(ts)::INT AS m, day(ts)::INT AS d, dayofyear(ts)::INT AS doy, strftime(ts, '%H:%M:%S') AS clock, (isodow(ts) - 1)::INT AS dow FROM events""",
)
def dt_parts(t):
    ts = "ts"
    return t.events.select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofmonth(ts).alias("d"), F.dayofyear(ts).alias("doy"),
        F.date_format(ts, "HH:mm:ss").alias("clock"), F.weekday(ts).alias("dow"),
    )


@query(
    "dt_add_sequence",
    "SELECT c_custkey, CAST(d0 + k AS VARCHAR) AS d FROM (SELECT o_custkey AS c_custkey, min(o_orderdate)::DATE AS d0 FROM orders GROUP BY 1), (SELECT unnest(range(12))::INT AS k)",
)
def dt_add_sequence(t):
    first = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("d0"))
    return first.select("c_custkey", F.explode(F.sequence("d0", F.date_add("d0", 11))).alias("d")).select("c_custkey", _s("d"))


@query(
    "dt_date_range",
    """SELECT CAST(d AS VARCHAR) AS d, isodow(d) < 6 AS business FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE::TIMESTAMP, max(o_orderdate)::DATE::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM orders)""",
)
def dt_date_range(t):
    d = calendar(t.orders.select(F.to_date("o_orderdate").alias("d")), "d")
    return d.select(_s("d"), (F.weekday("d") < 5).alias("business"))


@query(
    "dt_period_range",
    """SELECT strftime(m, '%Y-%m') AS period, CAST(m::DATE AS VARCHAR) AS start FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate))::TIMESTAMP, max(o_orderdate), INTERVAL 1 MONTH)) AS m FROM orders)""",
)
def dt_period_range(t):
    months = calendar(t.orders.select(F.trunc("o_orderdate", "month").alias("m")), "m", "1 month", "m")
    return months.select(F.date_format("m", "yyyy-MM").alias("period"), _s("m", "start"))


@query(
    "dt_timedelta_range",
    """SELECT n_nationkey, k, (k * 9000 + n_nationkey)::BIGINT AS secs FROM nation, (SELECT unnest(range(6))::INT AS k)""",
)
def dt_timedelta_range(t):
    d = t.nation.select("n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k"))
    step = F.make_dt_interval(hours=F.col("k") * 2, mins=F.col("k") * 30, secs=F.col("n_nationkey"))
    return d.select("n_nationkey", "k", F.expr("timestamp_ntz'1970-01-01'").alias("t0"), step.alias("delta")).select(
        "n_nationkey", "k", F.expr("timestampdiff(SECOND, t0, t0 + delta)").alias("secs")
    )


@query(
    "dt_offsets_end",
    """SELECT DISTINCT d::VARCHAR AS d, last_day(d)::VARCHAR AS me, (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE::VARCHAR AS qe, make_date(year(d), 12, 31)::VARCHAR AS ye,
       date_trunc('month', d)::DATE::VARCHAR AS ms, date_trunc('quarter', d)::DATE::VARCHAR AS qs, date_trunc('year', d)::DATE::VARCHAR AS ys FROM (SELECT o_orderdate::DATE AS d FROM orders)""",
)
def dt_offsets_end(t):
    d = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    cols = {
        "me": F.last_day("d"), "qe": F.date_sub(F.add_months(F.trunc("d", "quarter"), 3), 1), "ye": F.make_date(F.year("d"), F.lit(12), F.lit(31)),
        "ms": F.trunc("d", "month"), "qs": F.trunc("d", "quarter"), "ys": F.trunc("d", "year"),
    }
    return d.select(_s("d"), *[c.cast("string").alias(n) for n, c in cols.items()])


_BIZ = "({e} - greatest(isodow({e}) - 5, 0)::INT)"


@query(
    "dt_business_end",
    f"""SELECT DISTINCT d::VARCHAR AS d, {_BIZ.format(e='last_day(d)')}::DATE::VARCHAR AS bm, {_BIZ.format(e='make_date(year(d), 12, 31)')}::DATE::VARCHAR AS ba FROM (SELECT o_orderdate::DATE AS d FROM orders)""",
)
def dt_business_end(t):
    d = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return d.select(_s("d"), last_business_day(F.last_day("d")).cast("string").alias("bm"), business_year_end(F.year("d")).cast("string").alias("ba"))


@query(
    "dt_anchored_week",
    """SELECT (d + ((13 - isodow(d)) % 7)::INT)::DATE::VARCHAR AS week_end, count(*) AS n FROM (SELECT o_orderdate::DATE AS d FROM orders) GROUP BY 1""",
)
def dt_anchored_week(t):
    # weeks that end on Saturday (weekday 5)
    d = F.to_date("o_orderdate")
    end = F.date_add(d, F.pmod(5 - F.weekday(d), F.lit(7)).cast("int"))
    return t.orders.groupBy(end.cast("string").alias("week_end")).agg(F.count(F.lit(1)).alias("n"))


@query("dt_diff", "SELECT o_orderkey, date_diff('day', (SELECT min(o_orderdate) FROM orders), o_orderdate)::INT AS days FROM orders")
def dt_diff(t):
    first = t.orders.agg(F.min("o_orderdate")).scalar()
    return t.orders.select("o_orderkey", F.datediff("o_orderdate", first).alias("days"))


@query(
    "dt_unit_truncate",
    "SELECT event_id, date_trunc('hour', ts)::TIMESTAMP AS h, date_trunc('minute', ts)::TIMESTAMP AS m, date_trunc('second', ts)::TIMESTAMP AS s FROM events",
)
def dt_unit_truncate(t):
    return t.events.select("event_id", *[F.date_trunc(u, "ts").cast("timestamp_ntz").alias(u[0]) for u in ("hour", "minute", "second")])


@query(
    "dt_resample",
    """SELECT (date_trunc('week', ts)::DATE + 6)::DATE::VARCHAR AS week_end, round(sum(value), 2) AS total, count(*) AS n FROM events GROUP BY 1""",
)
def dt_resample(t):
    end = F.date_add(F.trunc("ts", "week"), 6)
    return t.events.groupBy(end.cast("string").alias("week_end")).agg(F.round(F.sum("value"), 2).alias("total"), F.count(F.lit(1)).alias("n"))


_D = "(SELECT o_orderdate::DATE AS d, round(sum(o_totalprice), 2) AS v FROM orders WHERE isodow(o_orderdate) < 6 GROUP BY 1)"


def _business_days(t):
    return daily(t.orders.filter(F.weekday("o_orderdate") < 5), "o_orderdate", F.round(F.sum("o_totalprice"), 2).alias("v"))


@query(
    "dt_asfreq",
    f"""WITH e AS (SELECT DISTINCT {_BIZ.format(e='make_date(year(d), 12, 31)')}::DATE AS d FROM {_D}) SELECT e.d::VARCHAR AS d, v FROM e LEFT JOIN {_D} x ON e.d = x.d""",
)
def dt_asfreq(t):
    d = _business_days(t)
    ends = d.select(business_year_end(F.year("d")).alias("d")).distinct()
    return ends.join(d, "d", "left").select(_s("d"), "v")


@query(
    "dt_asfreq_fill",
    f"""WITH c AS (SELECT unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM {_D}), j AS (SELECT c.d AS d, v FROM c LEFT JOIN {_D} x ON c.d = x.d)
        SELECT d::VARCHAR AS d, last_value(v IGNORE NULLS) OVER (ORDER BY d ROWS UNBOUNDED PRECEDING) AS ff, last_value(v IGNORE NULLS) OVER (ORDER BY d DESC ROWS UNBOUNDED PRECEDING) AS bf FROM j""",
)
def dt_asfreq_fill(t):
    d = _business_days(t)
    ff = filled_calendar(d, "d", "v").withColumnRenamed("v", "ff")
    bf = filled_calendar(d, "d", "v", forward=False).withColumnRenamed("v", "bf")
    return ff.join(bf, "d").select(_s("d"), "ff", "bf")


@query(
    "dt_time_of_day_profile",
    """SELECT isodow(ts) >= 6 AS weekend, hour(ts)::INT AS h, round(avg(value), 6) AS mean, count(*) AS n FROM events GROUP BY 1, 2""",
)
def dt_time_of_day_profile(t):
    return t.events.groupBy((F.weekday("ts") >= 5).alias("weekend"), F.hour("ts").alias("h")).agg(F.round(F.avg("value"), 6).alias("mean"), F.count(F.lit(1)).alias("n"))
