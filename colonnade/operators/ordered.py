"""Order-dependent operations without one-task windows.

Row positions, running totals and row frames over a whole table (or over a key
that may own most of it) are computed on *slices*: the rows are range-partitioned
by a unique ordering, each slice is processed on its own, and only one small row
per slice travels to put the slices together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from colonnade.session import checkpoint_root

_SEQ_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def _names(order: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sliced(df: DataFrame, order: Sequence) -> DataFrame:
    """Rows in ``order`` with ``_slice`` (range number) and ``_seq`` (place inside it).

    ``order`` must be unique per row, so a repeated value cannot overfill a slice.
    The result is checkpointed: range boundaries come from a sample, and everything
    built on top must see the same ones.
    """
    checkpoint_root(df.sparkSession)
    cols = _names(order)
    tagged = (
        df.repartitionByRange(*cols)
        .sortWithinPartitions(*cols)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_slice", F.shiftright("_mid", _SEQ_BITS))
        .withColumn("_seq", F.col("_mid").bitwiseAND(F.lit((1 << _SEQ_BITS) - 1)))
        .drop("_mid")
    )
    return tagged.checkpoint()


def _slice_offsets(d: DataFrame) -> DataFrame:
    # one row per slice, so the single-task window is bounded by the partition count
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    return (
        d.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    )


def _null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Join on equal keys where a null key equals a null key; the key columns appear once."""
    r = right.withColumnsRenamed({k: f"_on_{i}" for i, k in enumerate(on)})
    same = [F.col(k).eqNullSafe(F.col(f"_on_{i}")) for i, k in enumerate(on)]
    return left.join(r, reduce(lambda a, b: a & b, same), how).drop(*[f"_on_{i}" for i in range(len(on))])


def with_position(df: DataFrame, order: Sequence, name: str = "pos") -> DataFrame:
    """Add the 0-based position of every row in the global order."""
    d = sliced(df, order)
    return (
        d.join(F.broadcast(_slice_offsets(d)), "_slice")
        .withColumn(name, F.col("_seq") + F.col("_off"))
        .drop("_slice", "_seq", "_off")
    )


_RUNNING = {
    "sum": (lambda c: F.sum(c), lambda c: F.sum(c), lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))),
    "max": (lambda c: F.max(c), lambda c: F.max(c), lambda a, b: F.greatest(a, b)),
    "min": (lambda c: F.min(c), lambda c: F.min(c), lambda a, b: F.least(a, b)),
    "last": (
        lambda c: F.last(c, ignorenulls=True),
        lambda c: F.max_by(c, F.when(c.isNotNull(), F.col("_seq"))),
        lambda a, b: F.coalesce(a, b),
    ),
    "next": (
        lambda c: F.first(c, ignorenulls=True),
        lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("_seq"))),
        lambda a, b: F.coalesce(a, b),
    ),
}


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence, values: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Inclusive running aggregates per key, safe for a key of any size.

    ``values`` maps an output name to ``(kind, column)``; kinds are sum, max, min, last
    (most recent non-null value) and next (coming non-null value). Only keys that cross a slice boundary carry
    anything over, and there is at most one such key per boundary.
    """
    keys = list(keys)
    inputs = {f"_v{i}": (kind, out) for i, (out, (kind, _)) in enumerate(values.items())}
    staged = df.withColumns({f"_v{i}": c for i, (_, c) in enumerate(values.values())})
    d = sliced(staged, [*keys, *order])
    local = W.partitionBy("_slice", *keys).orderBy("_seq")
    past, coming = local.rowsBetween(W.unboundedPreceding, 0), local.rowsBetween(0, W.unboundedFollowing)
    own = d.withColumns(
        {out: _RUNNING[kind][0](F.col(v)).over(coming if kind == "next" else past) for v, (kind, out) in inputs.items()}
    )

    per_slice = d.groupBy("_slice", *keys).agg(
        *[_RUNNING[kind][1](F.col(v)).alias(v) for v, (kind, _) in inputs.items()]
    )
    if keys:
        heads = d.filter("_seq = 0").select(*keys).distinct()
        per_slice = _null_safe(per_slice, F.broadcast(heads), keys, "left_semi")
    slices = (W.partitionBy(*keys) if keys else W.partitionBy()).orderBy("_slice")
    earlier, later = slices.rowsBetween(W.unboundedPreceding, -1), slices.rowsBetween(1, W.unboundedFollowing)
    carry = per_slice.select(
        "_slice",
        *keys,
        *[_RUNNING[kind][0](F.col(v)).over(later if kind == "next" else earlier).alias(f"_c{v}") for v, (kind, _) in inputs.items()],
    )
    joined = _null_safe(own, F.broadcast(carry), ["_slice", *keys], "left")
    joined = joined.withColumns(
        {out: _RUNNING[kind][2](F.col(out), F.col(f"_c{v}")) for v, (kind, out) in inputs.items()}
    )
    return joined.drop("_slice", "_seq", *inputs, *[f"_c{v}" for v in inputs])


def framed(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    preceding: int,
    following: int,
    values: dict,
    block: int = 1 << 16,
) -> DataFrame:
    """Row-frame expressions of bounded reach, safe for a key of any size.

    ``values`` maps an output name to ``fn(window, frame) -> Column`` where ``window`` is
    the ordered window (for lag and lead) and ``frame`` the same with the row frame set.
    Positions are cut into blocks; rows near a block edge are copied to the neighbour so
    that every home row sees its whole frame.
    """
    keys = list(keys)
    reach = max(preceding, following, 1)
    block = max(block, 2 * reach)
    d = with_position(df, [*keys, *order], "_pos")
    touched = F.array_distinct(
        F.array(*[F.floor((F.col("_pos") + shift) / F.lit(block)) for shift in (-reach, 0, reach)])
    )
    copies = d.withColumn("_home", F.floor(F.col("_pos") / F.lit(block))).withColumn("_block", F.explode(touched))
    window = W.partitionBy("_block", *keys).orderBy("_pos")
    frame = window.rowsBetween(-preceding, following)
    return (
        copies.withColumns({out: fn(window, frame) for out, fn in values.items()})
        .filter("_block = _home")
        .drop("_pos", "_home", "_block")
    )


def _literals(one_row: DataFrame) -> dict[str, Column]:
    return {k: F.lit(v) for k, v in one_row.first().asDict().items()}


_SKETCH = 10000  # percentile_approx: rank error at most rows / 10000
_MARGIN = 3e-4  # bracket half-width in rank share; covers the sketch error and rounding
_SMALL = 50000  # groups below this size fit one aggregation buffer


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]
) -> DataFrame:
    """Interpolated percentiles per key, exact for any size and any number of distinct values.

    When no group is large the built-in aggregate does it, its buffer bounded by the checked
    group size. Otherwise a sketch brackets every wanted rank, one pass counts the rows below each bracket, and
    only the rows inside the brackets (well under a thousandth of a large group) are
    ranked. Repeated values are counted before they are ranked, and the ranking is a
    running total over slices, so no task ever holds a group.
    """
    keys = list(keys)
    d = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v is not null")
    names = list(probs)
    largest = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
    if largest < _SMALL:
        return d.groupBy(*keys).agg(*[F.percentile("_v", F.lit(float(p))).alias(n) for n, p in probs.items()])
    points = [p + side * _MARGIN for p in probs.values() for side in (-1, 1)]
    inner = sorted({min(max(p, 0.0), 1.0) for p in points})
    sketch = F.percentile_approx("_v", inner, _SKETCH).alias("_q")
    brackets = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), sketch)

    def bound(p: float) -> Column:
        open_end = F.lit(float("-inf") if p <= 0 else float("inf"))
        if p <= 0 or p >= 1:
            return open_end
        whole = F.lit(float("-inf") if points.index(p) % 2 == 0 else float("inf"))
        return F.when(F.col("_n") < _SMALL, whole).otherwise(F.col("_q")[inner.index(p)])

    bounds = [bound(p).alias(f"_{'lo' if i % 2 == 0 else 'hi'}{i // 2}") for i, p in enumerate(points)]
    brackets = brackets.select(*keys, "_n", *bounds)
    if keys:
        placed = _null_safe(d, brackets, keys, "inner")
    else:
        placed = d.withColumns(_literals(brackets))
    within = [F.col("_v").between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(len(names))]
    kept = within[0]
    for w in within[1:]:
        kept = kept | w

    below = placed.groupBy(*keys).agg(
        F.first("_n").alias("_n"),
        *[F.first(f"_{e}{i}").alias(f"_{e}{i}") for i in range(len(names)) for e in ("lo", "hi")],
        *[F.count_if(F.col("_v") < F.col(f"_lo{i}")).alias(f"_below{i}") for i in range(len(names))],
    )
    counts = placed.filter(kept).groupBy(*keys, "_v").agg(
        F.count(F.lit(1)).alias("_k"), *[F.bool_or(w).alias(f"_in{i}") for i, w in enumerate(within)]
    )
    cums = {f"_cum{i}": ("sum", F.when(F.col(f"_in{i}"), F.col("_k")).otherwise(0)) for i in range(len(names))}
    ranked = running(counts, keys, ["_v"], cums)
    if keys:
        ranked = _null_safe(ranked, below, keys, "inner")
    else:
        ranked = ranked.withColumns(_literals(below))
    exprs = []
    for i, (name, p) in enumerate(probs.items()):
        h = F.lit(p) * (F.col("_n") - 1)
        at = lambda rank: F.min(F.when(F.col(f"_in{i}") & (F.col(f"_cum{i}") + F.col(f"_below{i}") > rank), F.col("_v")))  # noqa: B023, E731
        lo, hi = at(F.floor(h)), at(F.ceil(h))
        exprs.append((lo + (hi - lo) * F.max(h - F.floor(h))).alias(name))
    return ranked.groupBy(*keys).agg(*exprs)
