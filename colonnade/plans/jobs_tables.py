"""Complete table analyses, each built from the operators above."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.functions import bins, geo
from colonnade.functions.text import clock_seconds
from colonnade.operators import sphere
from colonnade.operators import stats
from colonnade.operators.ordered import exact_percentiles
from colonnade.operators.relational import first_per_key, one_row, union_all
from colonnade.operators.timeseries import business_year_end, calendar, centred_reach, daily, filled_calendar, full_frame
from colonnade.plans.neighbours import spacing
from colonnade.plans.scalars_time import _BIZ
from colonnade.plans.statistics import _GR, gutenberg_richter
from colonnade.registry import query


def N():
    return F.count(F.lit(1))


def r(c, d=6):
    return F.round(c, d)


@query(
    "job_state_density",
    """WITH cust AS (SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN NULL ELSE 'NATION_' || c_nationkey END AS state FROM customer),
       pop AS (SELECT o_custkey, year(o_orderdate)::INT AS year, sum(o_totalprice) AS revenue FROM orders GROUP BY 1, 2),
       merged AS (SELECT coalesce(state, 'NATION_0') AS state, year, revenue FROM pop FULL JOIN cust ON o_custkey = c_custkey),
       area AS (SELECT n_name AS state, r_name, (n_nationkey + 1) * 997 AS area FROM nation JOIN region ON n_regionkey = r_regionkey)
       SELECT m.state, r_name, round(sum(revenue), 2) AS revenue, round(sum(revenue) / any_value(area), 6) AS density FROM merged m LEFT JOIN area USING (state) WHERE year = 1998 AND area IS NOT NULL GROUP BY 1, 2""",
)
def job_state_density(t):
    """Outer join, repair of unmatched names, area look-up, one year, ranked density."""
    # the year is chosen on the date column itself, so the scan skips the other years
    in_year = t.orders.filter("o_orderdate >= timestamp_ntz'1998-01-01' and o_orderdate < timestamp_ntz'1999-01-01'")
    pop = in_year.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.sum("o_totalprice").alias("revenue"))
    state = F.when(F.col("c_nationkey") != 0, F.concat(F.lit("NATION_"), "c_nationkey"))
    cust = t.customer.select("c_custkey", state.alias("state"))
    merged = pop.join(cust, F.col("o_custkey") == F.col("c_custkey"), "full")
    merged = merged.withColumn("state", F.when(F.col("state").isNull(), "NATION_0").otherwise(F.col("state")))
    area = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("state"), "r_name", ((F.col("n_nationkey") + 1) * 997).alias("area")
    )
    final = merged.filter("year is not null").groupBy("state").agg(F.sum("revenue").alias("revenue")).join(area, "state", "left").na.drop(subset=["area"])
    density = F.try_divide("revenue", "area")
    return final.select("state", "r_name", r("revenue", 2).alias("revenue"), r(density, 6).alias("density")).orderBy(F.desc("density"), "state")


@query(
    "job_planets_decades",
    """SELECT * FROM (PIVOT (SELECT p_type, 'd' || 10 * (year(l_shipdate) // 10) AS d FROM lineitem JOIN part ON l_partkey = p_partkey) ON d USING count(*) GROUP BY p_type)""",
)
def job_planets_decades(t):
    decade = F.concat(F.lit("d"), bins.floor_bucket(F.year("l_shipdate"), 10).cast("string"))
    d = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumn("decade", decade)
    return d.groupBy("p_type").pivot("decade").agg(N()).na.fill(0)


_SURV = """(SELECT (o_orderstatus = 'F')::INT AS survived, c_mktsegment AS sex, o_orderpriority AS class, CASE WHEN c_acctbal <= 5000 THEN 'young' ELSE 'old' END AS age,
    CASE WHEN o_totalprice <= (SELECT quantile_cont(o_totalprice, 0.5) FROM orders) THEN 'low' ELSE 'high' END AS fare FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(
    "job_survival_pivot",
    f"SELECT coalesce(sex, 'All') AS sex, coalesce(class, 'All') AS class, coalesce(age, 'All') AS age, coalesce(fare, 'All') AS fare, count(*) AS n, round(avg(survived), 6) AS rate FROM {_SURV} GROUP BY CUBE (sex, class, age, fare)",
)
def job_survival_pivot(t):
    half = exact_percentiles(t.orders, [], "o_totalprice", {"m": 0.5}).scalar()
    d = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        (F.col("o_orderstatus") == "F").cast("double").alias("survived"), F.col("c_mktsegment").alias("sex"), F.col("o_orderpriority").alias("class"),
        bins.cut("c_acctbal", [float("-inf"), 5000, float("inf")], ["young", "old"]).alias("age"), F.when(F.col("o_totalprice") <= half, "low").otherwise("high").alias("fare"),
    )
    keys = ["sex", "class", "age", "fare"]
    c = d.cube(*keys).agg(*[F.grouping(k).alias(f"g_{k}") for k in keys], N().alias("n"), r(F.avg("survived")).alias("rate"))
    return c.select(*[F.when(F.col(f"g_{k}") == 1, "All").otherwise(F.col(k)).alias(k) for k in keys], "n", "rate")


@query(
    "job_births",
    """WITH b AS (SELECT o_orderdate::DATE AS d, count(*) AS births FROM orders GROUP BY 1), q AS (SELECT quantile_cont(births::DOUBLE, 0.5) AS mu, 0.74 * (quantile_cont(births::DOUBLE, 0.75) - quantile_cont(births::DOUBLE, 0.25)) AS sig FROM b),
       k AS (SELECT d, births FROM b, q WHERE births > mu - 5 * sig AND births < mu + 5 * sig)
       SELECT 'weekday' AS view, (isodow(d) - 1)::INT AS a, (10 * (year(d) // 10))::INT AS b, round(avg(births), 6) AS mean FROM k GROUP BY 2, 3
       UNION ALL SELECT 'month_day', month(d)::INT, day(d)::INT, round(avg(births), 6) FROM k GROUP BY 2, 3""",
)
def job_births(t):
    b = daily(t.orders, "o_orderdate", N().alias("births"))
    # counts per day are few distinct numbers
    q = b.agg(F.percentile(F.col("births").cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).scalar()
    b = b.withColumn("q", q)
    mu, sig = F.col("q")[1], 0.74 * (F.col("q")[2] - F.col("q")[0])
    k = b.filter((F.col("births") > mu - 5 * sig) & (F.col("births") < mu + 5 * sig))
    mean = r(F.avg("births")).alias("mean")
    by_week = k.groupBy(F.weekday("d").alias("a"), bins.floor_bucket(F.year("d"), 10).alias("b")).agg(mean).select(F.lit("weekday").alias("view"), "a", "b", "mean")
    by_day = k.groupBy(F.month("d").alias("a"), F.dayofmonth("d").alias("b")).agg(mean).select(F.lit("month_day").alias("view"), "a", "b", "mean")
    return by_week.unionByName(by_day)


TERMS = ["the", "of", "que", "der"]


def _word(w):
    """Whole-word pattern whose borders are letters of any alphabet."""
    return rf"(?i)(^|[^\p{{L}}]){w}([^\p{{L}}]|$)"



@query(
    "job_recipe_recommender",
    "SELECT doc_id, n_chars, " + ", ".join(f"regexp_matches(text, '{_word(w)}') AS has_{w}" for w in TERMS)
    + ", doc_id = (SELECT arg_max(doc_id, (n_chars, -doc_id)) FROM documents) AS longest FROM documents WHERE " + f"regexp_matches(text, '{_word('the')}') AND regexp_matches(text, '{_word('of')}')",
)
def job_recipe_recommender(t):
    """Flags per term, documents holding several of them, and the longest one."""
    flags = {f"has_{w}": F.rlike("text", F.lit(_word(w))) for w in TERMS}
    longest = t.documents.agg(F.max_by("doc_id", F.struct("n_chars", (-F.col("doc_id")).alias("k")))).scalar()
    d = t.spread("documents").select("doc_id", "n_chars", *[c.alias(n) for n, c in flags.items()]).filter("has_the and has_of")
    return d.withColumn("longest", F.col("doc_id") == longest)


@query(
    "job_bike_counts",
    """WITH d AS (SELECT ts::DATE AS d, sum(value) AS v FROM events GROUP BY 1)
       SELECT 'week' AS view, (date_trunc('week', d)::DATE + 6)::DATE::VARCHAR AS key, round(sum(v), 2) AS v FROM d GROUP BY 2
       UNION ALL SELECT 'roll30', d::VARCHAR, CASE WHEN count(*) OVER w = 30 THEN round(sum(v) OVER w, 2) END FROM d WINDOW w AS (ORDER BY d ROWS BETWEEN 15 PRECEDING AND 14 FOLLOWING)
       UNION ALL SELECT 'hour', hour(ts)::VARCHAR, round(avg(value), 6) FROM events GROUP BY 2
       UNION ALL SELECT CASE WHEN isodow(ts) < 6 THEN 'Weekday' ELSE 'Weekend' END, hour(ts)::VARCHAR, round(avg(value), 6) FROM events GROUP BY 1, 2""",
)
def job_bike_counts(t):
    d = daily(t.events, "ts", F.sum("value").alias("v"))
    week = d.groupBy(F.date_add(F.trunc("d", "week"), 6).cast("string").alias("key")).agg(r(F.sum("v"), 2).alias("v")).withColumn("view", F.lit("week"))
    p, f = centred_reach(30)
    w = W.orderBy("d").rowsBetween(-p, f)
    roll = d.select(F.col("d").cast("string").alias("key"), full_frame(r(F.sum("v").over(w), 2), w, 30).alias("v"), F.lit("roll30").alias("view"))
    hour = F.hour("ts").cast("string").alias("key")
    by_hour = t.events.groupBy(hour).agg(r(F.avg("value")).alias("v")).withColumn("view", F.lit("hour"))
    kind = F.when(F.weekday("ts") < 5, "Weekday").otherwise("Weekend").alias("view")
    split = t.events.groupBy(kind, hour).agg(r(F.avg("value")).alias("v"))
    return union_all([week, roll, by_hour, split]).select("view", "key", "v")


@query(
    "job_stock_roi",
    f"""WITH b AS (SELECT o_orderdate::DATE AS d, round(sum(o_totalprice), 2) AS v FROM orders WHERE isodow(o_orderdate) < 6 GROUP BY 1), c AS (SELECT unnest(generate_series(min(d)::TIMESTAMP, max(d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d FROM b),
        f AS (SELECT c.d AS d, last_value(b.v IGNORE NULLS) OVER (ORDER BY c.d ROWS UNBOUNDED PRECEDING) AS v FROM c LEFT JOIN b ON c.d = b.d)
        SELECT d::VARCHAR AS d, v, round(100 * (lead(v, 365) OVER o - v) / v, 6) AS roi, CASE WHEN count(*) OVER w = 365 THEN round(avg(v) OVER w, 4) END AS mean, CASE WHEN count(*) OVER w = 365 THEN round(quantile_cont(v, 0.5) OVER w, 4) END AS med,
          d = {_BIZ.format(e='make_date(year(d), 12, 31)')}::DATE AS year_end, round(avg(v) OVER (PARTITION BY year(d)), 4) AS year_mean FROM f WINDOW o AS (ORDER BY d), w AS (ORDER BY d ROWS BETWEEN 182 PRECEDING AND 182 FOLLOWING)""",
)
def job_stock_roi(t):
    b = daily(t.orders.filter(F.weekday("o_orderdate") < 5), "o_orderdate", r(F.sum("o_totalprice"), 2).alias("v"))
    f = filled_calendar(b, "d", "v")
    o, w = W.orderBy("d"), W.orderBy("d").rowsBetween(-182, 182)
    v = F.col("v")
    out = f.select(
        "d", "v", r(F.try_divide(100 * (F.lead("v", 365).over(o) - v), v)).alias("roi"), full_frame(r(F.avg("v").over(w), 4), w, 365).alias("mean"),
        full_frame(r(F.percentile("v", F.lit(0.5)).over(w), 4), w, 365).alias("med"), (F.col("d") == business_year_end(F.year("d"))).alias("year_end"),
        r(F.avg("v").over(W.partitionBy(F.year("d"))), 4).alias("year_mean"),
    )
    return out.withColumn("d", F.col("d").cast("string"))


@query(
    "job_marathon_splits",
    """WITH m AS (SELECT event_type AS gender, 10 * (user_id // 10) AS age_dec, hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1 AS split, (hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 1) * 2 + value * 10 - 200 AS final FROM events)
       SELECT gender, age_dec::INT AS age_dec, count(*) AS n, round(avg(1 - 2 * split / final), 6) AS mean_frac, count(*) FILTER (1 - 2 * split / final < 0)::BIGINT AS negative FROM m WHERE final > 0 GROUP BY 1, 2""",
)
def job_marathon_splits(t):
    split = clock_seconds(F.date_format("ts", "HH:mm:ss")) + 1
    m = t.events.select(F.col("event_type").alias("gender"), bins.floor_bucket(F.col("user_id"), 10).alias("age_dec"), split.alias("split"), (split * 2 + F.col("value") * 10 - 200).alias("final"))
    frac = 1 - F.try_divide(2 * F.col("split"), "final")
    return m.filter("final > 0").groupBy("gender", "age_dec").agg(N().alias("n"), r(F.avg(frac)).alias("mean_frac"), F.count_if(frac < 0).alias("negative"))


@query(
    "job_rainy_days",
    """WITH d AS (SELECT o_orderdate::DATE AS d, greatest(0, count(*) - 3) AS rain, month(o_orderdate::DATE) BETWEEN 6 AND 8 AS summer FROM orders GROUP BY o_orderdate::DATE)
       SELECT count(*) FILTER (rain = 0) AS dry, count(*) FILTER (rain > 0) AS wet, count(*) FILTER (rain > 5) AS heavy, count(*) FILTER (rain > 0 AND rain < 3) AS light,
       quantile_cont(rain::DOUBLE, 0.5) FILTER (rain > 0) AS med_rainy, quantile_cont(rain::DOUBLE, 0.5) FILTER (summer) AS med_summer, max(rain) FILTER (summer)::BIGINT AS max_summer, quantile_cont(rain::DOUBLE, 0.5) FILTER (rain > 0 AND NOT summer) AS med_rainy_rest FROM d""",
)
def job_rainy_days(t):
    d = daily(t.orders, "o_orderdate", F.greatest(F.lit(0), N() - 3).alias("rain")).withColumn("summer", F.month("d").between(6, 8))
    rain, summer = F.col("rain"), F.col("summer")
    med = lambda c: F.percentile(F.when(c, rain).cast("double"), F.lit(0.5))
    return d.agg(
        F.count_if(rain == 0).alias("dry"), F.count_if(rain > 0).alias("wet"), F.count_if(rain > 5).alias("heavy"), F.count_if((rain > 0) & (rain < 3)).alias("light"),
        med(rain > 0).alias("med_rainy"), med(summer).alias("med_summer"), F.max(F.when(summer, rain)).alias("max_summer"), med((rain > 0) & ~summer).alias("med_rainy_rest"),
    )


@query(
    "job_president_heights",
    """SELECT round(avg(p_size), 6) AS mean, round(stddev_pop(p_size), 6) AS sd, min(p_size) AS lo, max(p_size) AS hi, quantile_cont(p_size::DOUBLE, 0.25) AS q25, quantile_cont(p_size::DOUBLE, 0.5) AS med, quantile_cont(p_size::DOUBLE, 0.75) AS q75 FROM part""",
)
def job_president_heights(t):
    s = "p_size"  # whole numbers up to 50
    q = F.percentile(F.col(s).cast("double"), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    d = t.part.agg(r(F.avg(s)).alias("mean"), r(F.stddev_pop(s)).alias("sd"), F.min(s).alias("lo"), F.max(s).alias("hi"), q.alias("q"))
    return d.select("mean", "sd", "lo", "hi", F.col("q")[0].alias("q25"), F.col("q")[1].alias("med"), F.col("q")[2].alias("q75"))


# city = event type, month = hour of day, baseline = days 1-10, decades = blocks of ten days
def _climate_sql(where):
    return f"""WITH e AS (SELECT event_type AS city, hour(ts) AS m, day(ts) AS dd, ts::DATE AS day, value FROM events WHERE {where}), b AS (SELECT city, m, avg(value) AS mu, stddev_samp(value) AS s FROM e WHERE dd <= 10 GROUP BY 1, 2),
        z AS (SELECT e.city, dd, (value - mu) / s AS z, value FROM e LEFT JOIN b USING (city, m)),
        t AS (SELECT city, count(*) FILTER (dd >= 20) AS n1, avg(value) FILTER (dd >= 20) AS m1, var_samp(value) FILTER (dd >= 20) AS v1, count(*) FILTER (dd <= 10) AS n2, avg(value) FILTER (dd <= 10) AS m2, var_samp(value) FILTER (dd <= 10) AS v2 FROM e GROUP BY 1),
        d AS (SELECT city, (dd // 10 * 10)::INT AS decade, count(z) AS n, count(*) FILTER (z > 2)::BIGINT AS hot, count(*) FILTER (z < -0.9)::BIGINT AS cold, max(value) AS hottest, min(value) AS coldest FROM z GROUP BY 1, 2),
        f AS (SELECT *, first_value(hot) OVER o AS hot0, first_value(n) OVER o AS n0 FROM d WINDOW o AS (PARTITION BY city ORDER BY decade)),
        q AS (SELECT *, (hot + hot0) / nullif(n + n0, 0)::DOUBLE AS pp FROM f),
        dm AS (SELECT city, day, avg(value) AS v FROM e GROUP BY 1, 2),
        ro AS (SELECT city, epoch(day) / 86400 AS x, CASE WHEN count(*) OVER w = 5 THEN avg(v) OVER w END AS y FROM dm WINDOW w AS (PARTITION BY city ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
        tr AS (SELECT city, regr_slope(y, x) AS trend FROM ro GROUP BY 1)
        SELECT city, decade, n, hot, cold, round((hot / nullif(n, 0)::DOUBLE - hot0 / nullif(n0, 0)::DOUBLE) / nullif(sqrt(pp * (1 - pp) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)), 0), 6) AS hot_z, round(trend, 8) AS trend, round(100.0 * hot / nullif(n, 0), 6)::DOUBLE AS hot_pct, hottest, coldest,
          round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)), 6) AS t_new_old FROM q JOIN t USING (city) JOIN tr USING (city)"""


def climate(e):
    """Extremes against the first ten days per city and block of ten days: counts, shares with a two-proportion test against the first block, a t test of the
    last days against the first, and the trend of the five-day rolling mean."""
    e = e.select(F.col("event_type").alias("city"), F.hour("ts").alias("m"), F.dayofmonth("ts").alias("dd"), F.to_date("ts").alias("day"), "value")
    base = e.filter("dd <= 10").groupBy("city", "m").agg(F.avg("value").alias("mu"), F.stddev("value").alias("s"))
    z = e.join(base, ["city", "m"], "left").withColumn("z", F.try_divide(F.col("value") - F.col("mu"), "s"))
    d = z.groupBy("city", bins.floor_bucket(F.col("dd"), 10).alias("decade")).agg(
        F.count("z").alias("n"), F.count_if(F.col("z") > 2).alias("hot"), F.count_if(F.col("z") < -0.9).alias("cold"), F.max("value").alias("hottest"), F.min("value").alias("coldest")
    )
    tt = stats.t_test(e, ["city"], F.col("value"), F.col("dd") >= 20, F.col("dd") <= 10).select("city", r("t").alias("t_new_old"))
    blocks = W.partitionBy("city").orderBy("decade")  # a few blocks for each city
    d = d.withColumns({"hot0": F.first("hot").over(blocks), "n0": F.first("n").over(blocks)})
    pooled = F.try_divide(F.col("hot") + F.col("hot0"), F.col("n") + F.col("n0"))
    share = F.try_divide("hot", "n") - F.try_divide("hot0", "n0")
    z = F.try_divide(share, F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), F.col("n")) + F.try_divide(F.lit(1.0), F.col("n0")))))
    days = W.partitionBy("city").orderBy("day").rowsBetween(-2, 2)  # one row for each calendar day
    smooth = e.groupBy("city", "day").agg(F.avg("value").alias("v")).select("city", F.unix_date("day").alias("x"), full_frame(F.avg("v").over(days), days, 5).alias("y"))
    trend = smooth.groupBy("city").agg(r(F.regr_slope("y", "x"), 8).alias("trend"))
    return d.join(tt, "city").join(trend, "city").select("city", "decade", "n", "hot", "cold", r(z).alias("hot_z"), "trend", r(F.try_divide(100.0 * F.col("hot"), "n")).alias("hot_pct"), "hottest", "coldest", "t_new_old")


@query("job_climate_extremes", _climate_sql("true"))
def job_climate_extremes(t):
    return climate(t.events)


@query("job_january_cold", _climate_sql("hour(ts) < 6"))
def job_january_cold(t):
    return climate(t.events.filter(F.hour("ts") < 6))


_SITES = "SELECT s_suppkey AS id, " + geo.location_sql("s_suppkey") + " FROM supplier"
_STATIONS = "SELECT c_custkey AS sid, " + geo.location_sql("c_custkey").replace("AS lat", "AS slat").replace("AS lon", "AS slon") + " FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"


@query(
    "job_station_siting",
    f"""WITH p AS (SELECT l_suppkey AS id, sum(l_quantity) AS volume, avg(l_discount) AS speed, stddev_samp(l_quantity) / avg(l_quantity) AS spread FROM lineitem GROUP BY 1),
        n AS (SELECT id, volume, (volume - min(volume) OVER ()) / (max(volume) OVER () - min(volume) OVER ()) AS nv, (speed - min(speed) OVER ()) / (max(speed) OVER () - min(speed) OVER ()) AS ns, (spread - min(spread) OVER ()) / (max(spread) OVER () - min(spread) OVER ()) AS nc FROM p),
        s AS (SELECT n.id, lat, lon, 0.5 * nv + 0.3 * (1 - ns) + 0.2 * (1 - nc) AS score FROM n JOIN ({_SITES}) USING (id)),
        d AS (SELECT id, any_value(lat) AS lat, any_value(lon) AS lon, any_value(score) AS score, min({geo.haversine_sql('lat', 'lon', 'slat', 'slon')}) AS km FROM s, ({_STATIONS}) GROUP BY 1)
        SELECT id, lat, lon, round(score, 6) AS score, round(km, 6) AS km FROM d ORDER BY round(score * km, 9) DESC, id LIMIT 3""",
)
def job_station_siting(t):
    """Demand score per location, distance to the nearest station, the three best underserved sites."""
    q = "l_quantity"
    p = t.lineitem.groupBy(F.col("l_suppkey").alias("id")).agg(F.sum(q).alias("volume"), F.avg("l_discount").alias("speed"), (F.stddev(q) / F.avg(q)).alias("spread"))
    ends = one_row(p, **{f"{a}_{c}": f(c) for c in ("volume", "speed", "spread") for a, f in (("lo", F.min), ("hi", F.max))})
    norm = lambda c: F.try_divide(F.col(c) - ends.getField(f"lo_{c}"), ends.getField(f"hi_{c}") - ends.getField(f"lo_{c}"))
    score = 0.5 * norm("volume") + 0.3 * (1 - norm("speed")) + 0.2 * (1 - norm("spread"))
    lat, lon = geo.location("s_suppkey")
    sites = p.select("id", score.alias("score")).join(t.supplier.select(F.col("s_suppkey").alias("id"), lat.alias("lat"), lon.alias("lon")), "id")
    clat, clon = geo.location("c_custkey")
    stations = t.customer.filter("c_mktsegment = 'AUTOMOBILE'").select(F.col("c_custkey").alias("id"), clat.alias("lat"), clon.alias("lon"))
    near = sphere.nearest_facility(sites.select("id", "lat", "lon"), stations)
    d = sites.join(near, "id").orderBy(F.desc(F.round(F.col("score") * F.col("km"), 9)), "id").limit(3)
    return d.select("id", "lat", "lon", r("score").alias("score"), r("km").alias("km"))


@query(
    "job_quake_catalogue",
    f"""SELECT * FROM (SELECT 'histogram' AS view, k::VARCHAR AS key, n::DOUBLE AS v FROM (SELECT floor(10 * ln(1 + value))::INT AS k, count(*) AS n FROM events GROUP BY 1)
        UNION ALL SELECT 'mean', event_type, round(avg(ln(1 + value)), 6) FROM events GROUP BY 2 UNION ALL SELECT 'median', event_type, round(quantile_cont(ln(1 + value), 0.5), 6) FROM events GROUP BY 2
        UNION ALL SELECT 'risk', n_name, round(count(*) * avg(greatest(c_acctbal, 0)) / 1000, 5) FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 2)
        UNION ALL ({_GR} SELECT 'b_value', 'all', round(-regr_slope(log10(above), k / 10.0::DOUBLE), 6) FROM c)""",
)
def job_quake_catalogue(t):
    mag = t.events.select("event_type", F.log1p("value").alias("mag"), F.floor(10 * F.log1p("value")).cast("int").alias("k"))
    hist = mag.groupBy(F.col("k").cast("string").alias("key")).agg(N().cast("double").alias("v")).withColumn("view", F.lit("histogram"))
    mean = mag.groupBy(F.col("event_type").alias("key")).agg(r(F.avg("mag")).alias("v")).withColumn("view", F.lit("mean"))
    med = exact_percentiles(mag, ["event_type"], "mag", {"v": 0.5}).select(F.col("event_type").alias("key"), r("v").alias("v"), F.lit("median").alias("view"))
    c = gutenberg_richter(t)
    b = c.agg(r(-F.regr_slope(F.log10("above"), F.col("k") / 10.0)).alias("v")).withColumns({"key": F.lit("all"), "view": F.lit("b_value")})
    risk = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("key")).agg(
        r(N() * F.avg(F.greatest("c_acctbal", F.lit(0.0))) / 1000, 5).alias("v")
    ).withColumn("view", F.lit("risk"))
    return union_all([x.select("view", "key", "v") for x in (hist, mean, med, b, risk)])


_WEC = "(SELECT vec_id, j::INT AS j, embedding[2 * j + 1]::DOUBLE AS x, embedding[2 * j + 2]::DOUBLE AS y FROM embeddings, (SELECT unnest(range(32)) AS j))"


@query(
    "job_wave_farm",
    f"""WITH s AS (SELECT vec_id, avg(m) AS spacing FROM (SELECT a.vec_id AS vec_id, a.j, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2)) AS m FROM {_WEC} a JOIN {_WEC} b ON a.vec_id = b.vec_id AND a.j <> b.j GROUP BY 1, 2) GROUP BY 1),
        f AS (SELECT vec_id, spacing, list_sum(list_transform(embedding::DOUBLE[], lambda v: abs(v))) AS power, label FROM s JOIN embeddings USING (vec_id)),
        g AS (SELECT CASE WHEN label <= 3 THEN 'low' WHEN label <= 6 THEN 'mid' ELSE 'high' END AS band, * FROM f)
        SELECT band, count(*) AS n, round(avg(power), 6) AS power, round(avg(spacing), 6) AS spacing, (SELECT arg_max(vec_id, power) FROM f) AS best, (SELECT arg_min(vec_id, power) FROM f) AS worst, (SELECT round(regr_slope(power, spacing), 4) FROM f) AS slope FROM g GROUP BY 1""",
)
def job_wave_farm(t):
    power = F.aggregate(F.transform("embedding", lambda v: F.abs(v.cast("double"))), F.lit(0.0), lambda a, x: a + x)
    f = spacing(t).select("vec_id", "label", "spacing", power.alias("power"))
    s = one_row(f, best=F.max_by("vec_id", "power"), worst=F.min_by("vec_id", "power"), slope=F.regr_slope("power", "spacing"))
    band = bins.cut("label", [-1, 3, 6, 9], ["low", "mid", "high"])
    g = f.groupBy(band.alias("band")).agg(N().alias("n"), r(F.avg("power")).alias("power"), r(F.avg("spacing")).alias("spacing"))
    return g.withColumns({"best": s.getField("best"), "worst": s.getField("worst"), "slope": r(s.getField("slope"), 4)})


@query(
    "job_energy_lcoe",
    """WITH y AS (SELECT s_suppkey, s_nationkey, 1000 + 100 * s_nationkey AS capex, 40 + s_nationkey AS opex, 0.2::DOUBLE + 0.01::DOUBLE * s_nationkey AS cf, unnest(range(1, 20 + s_nationkey % 6 + 1)) AS yr FROM supplier),
       d AS (SELECT s_suppkey, any_value(capex) AS capex, sum(opex / 1.07::DOUBLE ** yr) AS costs, sum(cf * 8760 / 1000 / 1.07::DOUBLE ** yr) AS energy, any_value(opex) AS opex, any_value(cf) * 8760 / 1000 AS mwh FROM y GROUP BY 1)
       SELECT s_suppkey, round((capex + costs) / energy, 6) AS lcoe, round(energy * 60 - capex - costs, 4) AS npv, round(CASE WHEN mwh * 60 > opex THEN capex / (mwh * 60 - opex) END, 6) AS payback FROM d""",
)
def job_energy_lcoe(t):
    """Levelised cost, net present value and payback per technology; one row per year of life, folded by partial sums."""
    n = F.col("s_nationkey")
    y = t.supplier.select(
        "s_suppkey", (1000 + 100 * n).alias("capex"), (40 + n).alias("opex"), (0.2 + 0.01 * n).alias("cf"), F.explode(F.sequence(F.lit(1), 20 + n % 6)).alias("yr")
    )
    disc = F.pow(F.lit(1.07), F.col("yr"))
    mwh = F.col("cf") * 8760 / 1000
    d = y.groupBy("s_suppkey").agg(
        F.first("capex").alias("capex"), F.sum(F.col("opex") / disc).alias("costs"), F.sum(mwh / disc).alias("energy"), F.first("opex").alias("opex"), F.first(mwh).alias("mwh")
    )
    yearly = F.col("mwh") * 60 - F.col("opex")
    return d.select(
        "s_suppkey", r((F.col("capex") + F.col("costs")) / F.col("energy")).alias("lcoe"), r(F.col("energy") * 60 - F.col("capex") - F.col("costs"), 4).alias("npv"),
        r(F.when(yearly > 0, F.col("capex") / yearly)).alias("payback"),
    )


_KW = geo.turbine_power_sql("(value * f / 10)")


@query(
    "job_wind_yield",
    f"""SELECT f AS factor, coalesce(day(ts)::INT, 0) AS day, count(*) AS hours, round(avg(value * f / 10), 10) AS mean_speed, round(sum({_KW}) / 1000, 4) AS mwh, round(sum({_KW}) / (2000.0::DOUBLE * count(*)), 6) AS capacity_factor
        FROM events, (SELECT unnest([0.5, 1.0, 1.5])::DOUBLE AS f) GROUP BY GROUPING SETS ((f, day(ts)), (f))""",
)
def job_wind_yield(t):
    v = t.events.select(F.dayofmonth("ts").alias("day"), "value", F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(1.5))).alias("factor"))
    v = v.withColumn("speed", F.col("value") * F.col("factor") / 10).withColumn("kw", geo.turbine_power(F.col("speed")))
    aggs = [N().alias("hours"), r(F.avg("speed"), 10).alias("mean_speed"), r(F.sum("kw") / 1000, 4).alias("mwh"), r(F.sum("kw") / (2000.0 * N())).alias("capacity_factor")]
    g = v.groupingSets([[F.col("factor"), F.col("day")], [F.col("factor")]], "factor", "day").agg(*aggs)
    return g.withColumn("day", F.coalesce("day", F.lit(0)))


@query(
    "job_data_quality",
    """WITH raw AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 97 = 0 THEN NULL WHEN l_partkey % 89 = 0 THEN -l_quantity WHEN l_partkey % 83 = 0 THEN l_quantity * 100 ELSE l_quantity END AS x, l_extendedprice AS y FROM lineitem),
       u AS (SELECT l_orderkey, l_linenumber, arg_min(x, (l_partkey, y)) AS x0, arg_min((x, y), (l_partkey, y)) AS r FROM raw GROUP BY 1, 2), d AS (SELECT r[1] AS x, r[2] AS y FROM u),
       c AS (SELECT * FROM d WHERE x IS NOT NULL AND x > 0 AND x <= 50)
       SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM d) AS distinct_rows, (SELECT count(*) FROM d WHERE x IS NULL) AS nulls, (SELECT count(*) FROM d WHERE x < 0) AS negatives, (SELECT count(*) FROM d WHERE x > 50) AS outliers,
       (SELECT count(*) FROM c) AS clean_rows, (SELECT round(regr_slope(y, x), 6) FROM d) AS slope_before, (SELECT round(regr_slope(y, x), 6) FROM c) AS slope_after""",
)
def job_data_quality(t):
    k = F.col("l_partkey")
    x = F.when(k % 97 == 0, None).when(k % 89 == 0, -F.col("l_quantity")).when(k % 83 == 0, F.col("l_quantity") * 100).otherwise(F.col("l_quantity"))
    raw = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", x.alias("x"), F.col("l_extendedprice").alias("y"))
    d = first_per_key(raw, ["l_orderkey", "l_linenumber"], ["l_partkey", "y"])
    ok = F.coalesce((F.col("x") > 0) & (F.col("x") <= 50), F.lit(False))
    s = d.agg(
        N().alias("distinct_rows"), F.count_if(F.col("x").isNull()).alias("nulls"), F.count_if(F.col("x") < 0).alias("negatives"), F.count_if(F.col("x") > 50).alias("outliers"),
        F.count_if(ok).alias("clean_rows"), r(F.regr_slope("y", "x")).alias("slope_before"), r(F.regr_slope(F.when(ok, F.col("y")), F.when(ok, F.col("x")))).alias("slope_after"),
    )
    return s.withColumn("raw_rows", raw.agg(N()).scalar())


@query(
    "job_concrete_qc",
    """WITH c AS (SELECT p_brand, p_size, p_retailprice, p_size * 4.448::DOUBLE AS load FROM part)
       SELECT p_brand, count(*) AS n, count(*) FILTER (p_size >= 25)::BIGINT AS passing, round(avg((p_size >= 25)::INT), 6) AS pass_share, round(sum(p_size) / sum(p_retailprice), 8) AS strength_per_cost, count(*) FILTER (80 / load < 1.5)::BIGINT AS critical FROM c GROUP BY 1""",
)
def job_concrete_qc(t):
    load = F.col("p_size") * 4.448
    ok = F.col("p_size") >= 25
    d = t.part.groupBy("p_brand").agg(
        N().alias("n"), F.count_if(ok).alias("passing"), r(F.avg(ok.cast("double"))).alias("pass_share"), r(F.sum("p_size") / F.sum("p_retailprice"), 8).alias("strength_per_cost"),
        F.count_if(F.try_divide(F.lit(80.0), load) < 1.5).alias("critical"),
    )
    return d.orderBy(F.desc("strength_per_cost"), "p_brand")


@query(
    "job_anscombe",
    """SELECT l_returnflag AS dataset, count(*) AS n, round(avg(l_quantity), 6) AS mx, round(avg(l_extendedprice), 4) AS my, round(var_samp(l_quantity), 6) AS vx, round(stddev_samp(l_extendedprice), 4) AS sy, round(corr(l_quantity, l_extendedprice), 6) AS r,
       round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem GROUP BY 1""",
)
def job_anscombe(t):
    x, y = "l_quantity", "l_extendedprice"
    return t.lineitem.groupBy(F.col("l_returnflag").alias("dataset")).agg(
        N().alias("n"), r(F.avg(x)).alias("mx"), r(F.avg(y), 4).alias("my"), r(F.variance(x)).alias("vx"), r(F.stddev(y), 4).alias("sy"), r(F.corr(x, y)).alias("r"),
        r(F.regr_slope(y, x)).alias("slope"), r(F.regr_intercept(y, x), 4).alias("intercept"),
    )
