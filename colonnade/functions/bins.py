"""Binning expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_bucket(value, width: float) -> Column:
    """Lower edge of the fixed-width bucket holding ``value`` (e.g. the decade of a year)."""
    return (F.floor(value / F.lit(width)) * F.lit(width)).cast("int")


def cut(value, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed bins ``(lo, hi]``; null outside, as labels or as bin numbers."""
    v = F.col(value) if isinstance(value, str) else value
    labels = list(labels) if labels is not None else list(range(len(edges) - 1))
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        inside = (v > F.lit(lo)) & (v <= F.lit(hi))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def hist_bin(value, lo, width, bins: int) -> Column:
    """Equal-width bin number; the last bin is closed on the right, null outside."""
    v = F.col(value) if isinstance(value, str) else value
    k = F.floor((v - lo) / width).cast("int")
    return F.when((k >= 0) & (k < bins), k).when(v == lo + width * bins, F.lit(bins - 1))


def hex_cell(x: Column, y: Column, size: float) -> tuple[Column, Column]:
    """Axial coordinates of the flat hexagon (edge ``size``) holding a point.

    Cube rounding: round all three coordinates, then repair the one that moved most.
    """
    q = x * F.lit(2.0 / 3.0 / size)
    r = x * F.lit(-1.0 / 3.0 / size) + y * F.lit(3.0**0.5 / 3.0 / size)
    s = -q - r
    rq, rr, rs = (F.floor(c + 0.5) for c in (q, r, s))
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    qi = F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq)
    ri = F.when((dr > ds) & ~((dq > dr) & (dq > ds)), -rq - rs).otherwise(rr)
    return qi.cast("int"), ri.cast("int")
