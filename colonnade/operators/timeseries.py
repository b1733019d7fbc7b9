"""Calendar series: daily tables, centred frames, weighted rolling sums, regular calendars."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators.relational import one_row


def daily(df: DataFrame, ts: str, *aggs: Column) -> DataFrame:
    """One row per calendar day; everything after it is bounded by the calendar."""
    return df.groupBy(F.to_date(ts).alias("d")).agg(*aggs)


def centred_reach(width: int) -> tuple[int, int]:
    """Rows before and after the current one in a centred frame of ``width`` rows."""
    after = (width - 1) // 2
    return width - 1 - after, after


def full_frame(value: Column, frame, width: int) -> Column:
    """Null until the frame holds ``width`` rows."""
    return F.when(F.count(F.lit(1)).over(frame) == width, value)


def gaussian_rolling(df: DataFrame, order: str, value: str, width: int, std: float, out: str) -> DataFrame:
    """Centred rolling sum with Gaussian weights over a calendar-bounded series."""
    before, after = centred_reach(width)
    frame = W.orderBy(order).rowsBetween(-before, after)
    mid = (width - 1) / 2
    weights = F.array(*[F.lit(math.exp(-0.5 * ((k - mid) / std) ** 2)) for k in range(width)])
    values = F.collect_list(value).over(frame)
    total = F.aggregate(F.zip_with("_vals", weights, lambda v, w: v * w), F.lit(0.0), lambda a, x: a + x)
    return df.withColumn("_vals", values).withColumn(out, F.when(F.size("_vals") == width, total)).drop("_vals")


def calendar(df: DataFrame, date: str, step: str = "1 day", name: str = "d") -> DataFrame:
    """Every date between the first and last of a column."""
    ends = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    return ends.select(F.explode(F.expr(f"sequence(lo, hi, interval {step})")).alias(name))


def business_year_end(year: Column) -> Column:
    """Last weekday of a year."""
    end = F.make_date(year, F.lit(12), F.lit(31))
    return last_business_day(end)


def last_business_day(end: Column) -> Column:
    """Step back from a period end that falls on a weekend."""
    return F.date_sub(end, F.greatest(F.weekday(end) - 4, F.lit(0)))


def filled_calendar(df: DataFrame, date: str, value: str, forward: bool = True) -> DataFrame:
    """Up-sample a daily series to every date, carrying values over the gaps."""
    cal = calendar(df, date, name=date)
    w = W.orderBy(date)
    if forward:
        filled = F.last(value, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    else:
        filled = F.first(value, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return cal.join(df, date, "left").withColumn(value, filled)
