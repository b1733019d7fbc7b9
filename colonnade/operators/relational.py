"""Small relational operators shared by the queries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.operators.ordered import with_position


def pick_positions(df: DataFrame, order: Sequence, wanted: DataFrame) -> DataFrame:
    """Rows at the positions listed in ``wanted.pos``."""
    return with_position(df, order).join(wanted, "pos")


def matrix_cells(df: DataFrame, row: str, vector: str) -> DataFrame:
    """A table of vectors as cells ``(i, j, v)``."""
    return df.select(F.col(row).alias("i"), F.posexplode(vector).alias("j", "v")).withColumn("v", F.col("v").cast("double"))


def accumulate_positions(base: DataFrame, positions: DataFrame, key: str, out: str) -> DataFrame:
    """How often each key of ``base`` occurs in ``positions``; zero where it does not."""
    counts = positions.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return base.join(counts, key, "left").withColumn(out, F.coalesce(out, F.lit(0)))


def last_write_wins(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(value, order).alias(value))


def add_or_keep(df: DataFrame, column: str, cond: Column, value: Column) -> DataFrame:
    """Set ``column`` to ``value`` where ``cond`` holds."""
    return df.withColumn(column, F.when(cond, value).otherwise(F.col(column)))


def lookup_values(df: DataFrame, column: str, mapping: dict, out: str) -> DataFrame:
    """Map values through a small dictionary; unknown values become null."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return df.withColumn(out, F.try_element_at(table, F.col(column)))


def hash_sample(df: DataFrame, key: str, modulus: int, keep: int) -> DataFrame:
    """A repeatable sample: keys whose multiplicative hash falls into one class."""
    return df.filter((F.col(key) * 48271) % 2147483647 % modulus == keep)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of every key in ``order``.

    ``min_by`` keeps one row per key and task, so a hot key is reduced before the shuffle.
    """
    row = F.struct(*df.columns)
    return df.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_r")).select("_r.*")


def one_row(df: DataFrame, **aggs: Column) -> Column:
    """Several whole-table aggregates as one scalar struct."""
    return df.agg(F.struct(*[c.alias(n) for n, c in aggs.items()]).alias("s")).scalar()


def null_safe_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other."""
    r = right.withColumnRenamed(key, f"_{key}")
    return left.join(r, F.col(key).eqNullSafe(F.col(f"_{key}")), how).drop(f"_{key}")


def suffixed(df: DataFrame, on: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in on})


def union_all(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)


def interval_bucket(value: Column, edges: Sequence[float], right: bool = True) -> Column:
    """Index of the interval of a short edge list holding ``value``; null outside."""
    expr = None
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        inside = ((value > lo) & (value <= hi)) if right else ((value >= lo) & (value < hi))
        expr = F.when(inside, i) if expr is None else expr.when(inside, i)
    return expr


def top_rows_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Top ``n`` rows per key; the limit is applied in every task before the shuffle."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
