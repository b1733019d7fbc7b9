"""Special functions as column expressions.

All are standard series: the positive Kummer series and the continued fraction for
erf/erfc, Stirling's series with an argument shift for ln gamma, Newton steps for the
normal quantile. The long loops (erf, erfc, quantile) run over whole Arrow batches, since
Spark interprets a higher-order function step by step; the rest is compiled in the JVM.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_SPLIT = 2.5  # below: power series, above: continued fraction
_SERIES, _FRACTION = 45, 30


def _erf_small(x: np.ndarray) -> np.ndarray:
    z, acc = 2 * x * x, np.ones_like(x)
    for n in range(_SERIES, 0, -1):
        acc = 1 + z / (2 * n + 1) * acc
    return 2 / math.sqrt(math.pi) * x * np.exp(-x * x) * acc


def _erfc_large(x: np.ndarray) -> np.ndarray:
    acc = x
    for n in range(_FRACTION, 0, -1):
        acc = x + n / 2 / acc
    return np.exp(-x * x) / math.sqrt(math.pi) / acc


def _erfs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """erf and erfc of every entry."""
    a = np.abs(x)
    below = a < _SPLIT
    small, tail = _erf_small(np.where(below, x, 0.0)), _erfc_large(np.where(below, _SPLIT, a))
    return np.where(below, small, np.sign(x) * (1 - tail)), np.where(below, 1 - small, np.where(x > 0, tail, 2 - tail))


def _quantile(p: np.ndarray) -> np.ndarray:
    x = 4.91 * (np.power(p, 0.14) - np.power(1 - p, 0.14))
    for _ in range(8):
        x = x - (0.5 * _erfs(-x / math.sqrt(2))[1] - p) / (np.exp(-0.5 * x * x) / math.sqrt(2 * math.pi))
    return x


def _batched(x: Column, f, inside=None) -> Column:
    """``f`` over the batches of a column; null stays null, and what is not ``inside`` becomes null."""

    @F.arrow_udf(DoubleType())
    def mapped(v: pa.Array) -> pa.Array:
        a, keep = v.to_numpy(zero_copy_only=False).astype(float), v.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(a))
        with np.errstate(all="ignore"):
            keep = keep if inside is None else keep & inside(a)
            out[keep] = f(a[keep])
        return pa.array(out, mask=~keep)

    return mapped(x.cast("double"))


def erf(x: Column) -> Column:
    return _batched(x, lambda a: _erfs(a)[0])


def erfc(x: Column) -> Column:
    return _batched(x, lambda a: _erfs(a)[1])


def erf_sql(x: str) -> str:
    """The same function as SQL text, for comparison queries."""
    acc = "1.0::DOUBLE"
    for n in range(_SERIES, 0, -1):
        acc = f"(1 + z / {2 * n + 1}.0 * {acc})"
    tail = "a"
    for n in range(_FRACTION, 0, -1):
        tail = f"(a + {n / 2.0} / {tail})"
    return (
        f"(SELECT CASE WHEN a < {_SPLIT} THEN 2 / sqrt(pi()) * ex * exp(-ex * ex) * {acc} "
        f"ELSE sign(ex) * (1 - exp(-a * a) / sqrt(pi()) / {tail}) END FROM (SELECT ex, abs(ex) AS a, 2 * ex * ex AS z FROM (SELECT ({x})::DOUBLE AS ex)))"
    )


def norm_pdf(x: Column, mean=0.0, sd=1.0) -> Column:
    m, s = (c if isinstance(c, Column) else F.lit(float(c)) for c in (mean, sd))
    z = (x - m) / s
    return F.exp(-0.5 * z * z) / (s * F.lit(math.sqrt(2 * math.pi)))


def norm_cdf(z: Column) -> Column:
    return 0.5 * erfc(-z / F.lit(math.sqrt(2)))


def norm_sf(z: Column) -> Column:
    return 0.5 * erfc(z / F.lit(math.sqrt(2)))


def norm_ppf(p: Column) -> Column:
    """Normal quantile: a power-law start, then Newton steps on the exact cdf."""
    return _batched(p, _quantile, lambda a: (a > 0) & (a < 1))


def erfinv(y: Column) -> Column:
    return norm_ppf((y + 1) / 2) / F.lit(math.sqrt(2))


_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def lgamma(x: Column) -> Column:
    """ln gamma for positive arguments, shifted by 8 into the range of Stirling's series."""
    y = x + 8
    shift = F.lit(0.0)
    for k in range(8):
        shift = shift + F.ln(x + k)
    series = F.lit(0.0)
    for k, c in enumerate(_STIRLING):
        series = series + F.lit(c) / F.pow(y, F.lit(2.0 * k + 1))
    return (y - 0.5) * F.ln(y) - y + F.lit(0.5 * math.log(2 * math.pi)) + series - shift


def gamma(x: Column) -> Column:
    return F.exp(lgamma(x))


def beta(a: Column, b: Column) -> Column:
    return F.exp(lgamma(a) + lgamma(b) - lgamma(a + b))


def logaddexp(a: Column, b: Column) -> Column:
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))
