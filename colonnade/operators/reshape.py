"""Operators that change the shape of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Values that become columns at most; a wider table is no pivot any more.
MOST_COLUMNS = 10_000


def found_values(df: DataFrame, value: Column) -> list:
    """The different values of a column or expression, sorted, by one aggregated pass; more than ``MOST_COLUMNS`` are an error, as in ``pivot``."""
    rows = df.select(value.alias("v")).filter("v is not null").distinct().orderBy("v").limit(MOST_COLUMNS + 1).collect()
    if len(rows) > MOST_COLUMNS:
        raise ValueError(f"over {MOST_COLUMNS} values for columns")
    return [r["v"] for r in rows]


def margin_pivot(df: DataFrame, row: str, column: str, agg: Callable[[], Column], label: str = "All") -> DataFrame:
    """Pivot over all values with subtotals: one cube aggregation, then a pivot of its few cells."""
    name = lambda c: F.when(F.grouping(c) == 1, label).otherwise(F.col(c))
    cells = df.cube(row, column).agg(name(row).alias("_r"), name(column).alias("_c"), agg().alias("_v"))
    return cells.groupBy("_r").pivot("_c").agg(F.first("_v")).withColumnRenamed("_r", row)


def cells_transposed(df: DataFrame, row: str, vector: str) -> DataFrame:
    """Transpose of a table of vectors, in cell form ``(i, j, v)``."""
    return df.select(F.col(row).alias("j"), F.posexplode(vector).alias("i", "v")).select("i", "j", F.col("v").cast("double").alias("v"))


def indicator_columns(df: DataFrame, array: str, keep: Sequence[str]) -> DataFrame:
    """One 0/1 column for every value that an array column holds in some row."""
    values = found_values(df, F.explode(array))
    return df.select(*keep, *[F.array_contains(array, v).cast("int").alias(v) for v in values])
