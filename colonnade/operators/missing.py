"""Missing-data operators. NaN is turned into null on the way in; null is skipped afterwards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.operators.ordered import running
from colonnade.operators.relational import one_row


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and share per column, one row per column, in one pass."""
    stats = df.agg(
        *[F.struct(F.count_if(F.col(c).isNull()).alias("n_null"), F.avg(F.col(c).isNull().cast("double")).alias("share")).alias(c) for c in columns]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c)["n_null"].alias("n_null"), F.round(F.col(c)["share"], 6).alias("share")) for c in columns])
    return stats.select(F.inline(rows))


def non_null_columns(df: DataFrame, how: str = "any") -> DataFrame:
    """Drop columns that hold any (or only) nulls. One row of counts decides the schema."""
    counts = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in df.columns]).first()
    floor = counts["_n"] if how == "any" else min(1, counts["_n"])
    return df.select([c for c in df.columns if counts[c] >= floor])


def fill_from_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, backward: bool = False) -> DataFrame:
    """Replace nulls by the last known (or, backward, the next known) value of the key."""
    kind = "next" if backward else "last"
    return running(df, keys, list(order), {"_filled": (kind, F.col(value))}).withColumn(value, F.col("_filled")).drop("_filled")


def mean_imputed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    means = one_row(df, **{c: F.avg(c) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), means.getField(c)) for c in columns})
