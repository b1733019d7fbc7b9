"""Statistics as aggregations: moments, tests, fits and kernel densities."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions import special
from colonnade.functions.special import norm_pdf
from colonnade.operators.ordered import with_position


def pooled_t(n1: Column, m1: Column, v1: Column, n2: Column, m2: Column, v2: Column) -> Column:
    """Two-sample t statistic with pooled variance."""
    pooled = ((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)
    return (m1 - m2) / F.sqrt(pooled * (1 / n1 + 1 / n2))


def side_moments(value: Column, cond: Column, tag: str) -> list[Column]:
    """Count, mean and variance of the rows where ``cond`` holds, as aggregates."""
    v = F.when(cond, value)
    return [F.count(v).alias(f"n{tag}"), F.avg(v).alias(f"m{tag}"), F.variance(v).alias(f"v{tag}")]


def t_test(df: DataFrame, keys: Sequence[str], value: Column, first: Column, second: Column) -> DataFrame:
    """Pooled t test per key from one pass of conditional moments."""
    m = df.groupBy(*keys).agg(*side_moments(value, first, "1"), *side_moments(value, second, "2"))
    t = pooled_t(*[F.col(c) for c in ("n1", "m1", "v1", "n2", "m2", "v2")])
    return m.withColumn("t", t).withColumn("df", F.col("n1") + F.col("n2") - 2)


def with_t_pvalue(df: DataFrame, t: str, dof: str, out: str = "p") -> DataFrame:
    """Two-sided p value by numeric integration of the t density in cos-form.

    The tail of Student's t with n degrees of freedom is an incomplete beta integral; the
    substitution t = sqrt(n) tan(a) gives the smooth integrand cos(a)^(n-1), integrated by
    Simpson's rule inside the row.
    """
    steps = 2000
    n = F.col(dof).cast("double")
    angle = F.atan(F.abs(F.col(t)) / F.sqrt(n))
    half = F.lit(math.pi / 2)

    def simpson(lo: Column, hi: Column) -> Column:
        h = (hi - lo) / steps
        weight = lambda k: F.when((k == 0) | (k == steps), 1.0).when(k % 2 == 1, 4.0).otherwise(2.0)
        total = F.aggregate(
            F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0),
            lambda a, k: a + weight(k) * F.pow(F.greatest(F.cos(lo + k * h), F.lit(0.0)), n - 1),
        )
        return total * h / 3

    return df.withColumn(out, simpson(angle, half) / simpson(F.lit(0.0), half))


def stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


KERNELS: dict[str, Callable[[Column], Column]] = {
    "gaussian": lambda u: norm_pdf(u),
    "tophat": lambda u: F.when(F.abs(u) <= 1, 0.5).otherwise(0.0),
}


def kde(df: DataFrame, keys: Sequence[str], value: str, grid: Sequence[float], bandwidth: float, kernel: str = "gaussian") -> DataFrame:
    """Kernel density on a fixed grid, as ``(keys, x, density)``.

    Every row meets the grid inside its task and is folded at once into one partial sum per
    grid point, so the shuffle carries only grid-sized tables.
    """
    d = df.select(*keys, F.col(value).cast("double").alias("_v"), F.explode(F.array(*[F.lit(float(g)) for g in grid])).alias("x"))
    return d.groupBy(*keys, "x").agg(F.avg(KERNELS[kernel]((F.col("x") - F.col("_v")) / bandwidth) / bandwidth).alias("density"))


def on_grid(df: DataFrame, xs: Sequence[float], ys: Sequence[float]) -> DataFrame:
    """Rows met with a fixed two-dimensional grid: adds ``i, j, gx, gy``."""
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(x)).alias("gx"), F.lit(float(y)).alias("gy")) for i, x in enumerate(xs) for j, y in enumerate(ys)])
    return df.select("*", F.inline(cells))


def moments_corr_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All-pairs Pearson correlation, one row per pair, from one aggregation."""
    pairs = [(a, b) for a in columns for b in columns]
    wide = df.agg(*[F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("r")) for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(rows))


def hash_uniform(*parts: Column) -> Column:
    """A repeatable uniform number in [0, 1) from key columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))


def hash_normal(*parts: Column) -> Column:
    """A repeatable standard normal number from key columns."""
    u, v = hash_uniform(F.lit(1), *parts), hash_uniform(F.lit(2), *parts)
    return F.sqrt(-2 * F.ln(F.greatest(u, F.lit(1e-12)))) * F.cos(2 * math.pi * v)


def poisson_counts(keys, replicates: int, mean: float):
    """Repeatable Poisson draws, rows x replicates: a mixed 64-bit hash of key and replicate against the distribution's steps."""
    import numpy as np

    upto = int(mean + 12 * math.sqrt(mean) + 12)
    terms = np.cumsum([math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(upto + 1)])
    x = keys.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, replicates + 1, dtype=np.uint64)[None] * np.uint64(0xD1B54A32D192ED03)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    u = ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.searchsorted(terms, u, side="right").astype(np.float64)


def little_bootstraps(df: DataFrame, key: str, xs: Sequence[Column], y: Column, subsets: int = 20, replicates: int = 50) -> tuple[list[float], list[float], int]:
    """Least-squares coefficients of ``y`` on ``xs``, their standard errors, and the number of refits, by a bag of little bootstraps.

    Rows are dealt to subsets by the hash of their key. In a subset every replicate weighs each row with a Poisson draw of mean ``subsets``, so a
    replicate stands for a resample as large as the whole table; the spread over a subset's replicates is an
    error, and the errors are averaged. A row meets ``replicates`` weights, not ``subsets * replicates``. A batch is folded by one matrix
    product into weighted cross products; what reaches the driver is one row per subset and replicate. Rows with nulls or non-finite values are left out.
    """
    import numpy as np

    p = len(xs)
    cols = [*(c.cast("double").alias(f"x{i}") for i, c in enumerate(xs)), y.cast("double").alias("y")]
    names = [*(f"x{i}" for i in range(p)), "y"]
    fine = " and ".join(f"{n} is not null and not isnan({n}) and abs({n}) < double('infinity')" for n in names)
    d = df.select(F.xxhash64(F.col(key)).alias("h"), F.pmod(F.xxhash64(F.lit(23), F.col(key)), F.lit(subsets)).cast("int").alias("s"), *cols).filter(fine)
    pairs = [(i, j) for i in range(p + 1) for j in range(i, p + 1) if i < p]

    def fold(batches):
        import pyarrow as pa

        total = {}
        for b in batches:
            h, s = (b.column(c).to_numpy(zero_copy_only=False) for c in ("h", "s"))
            v = np.column_stack([b.column(c).to_numpy(zero_copy_only=False) for c in names])
            products = np.column_stack([v[:, i] * v[:, j] for i, j in pairs])
            for k in np.unique(s).tolist():
                own = np.flatnonzero(s == k)
                w = np.concatenate([np.ones((len(own), 1)), poisson_counts(h[own], replicates, subsets)], axis=1)  # the first column is the plain fit
                total[k] = total.get(k, 0) + w.T @ products[own]
        for k, sums in total.items():
            n = len(sums)
            yield pa.RecordBatch.from_arrays([pa.array([k] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array(sums.tolist(), pa.list_(pa.float64()))], ["s", "r", "sums"])

    parts = d.mapInArrow(fold, "s int, r int, sums array<double>")
    rows = parts.groupBy("s", "r").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"m{i}") for i in range(len(pairs))]).orderBy("s", "r").collect()

    def solve(sums):
        a, b = np.zeros((p, p)), np.zeros(p)
        for (i, j), v in zip(pairs, sums):
            if j == p:
                b[i] = v
            else:
                a[i, j] = a[j, i] = v
        return np.linalg.lstsq(a, b, rcond=None)[0]

    if not rows:
        return [], [], 0
    plain = solve(np.sum([r[2:] for r in rows if r["r"] == 0], axis=0))
    runs: dict[int, list] = {}
    for r in rows:
        if r["r"]:
            runs.setdefault(r["s"], []).append(solve(r[2:]))
    errors = np.mean([np.std(np.array(own), axis=0) for own in runs.values()], axis=0)
    return plain.tolist(), errors.tolist(), sum(map(len, runs.values()))


def shapiro_francia(df: DataFrame, key: str, value: str) -> DataFrame:
    """``n``, ``statistic`` and ``p_value`` of the Shapiro-Francia test of normality, as one row.

    Every value meets the normal score of its exact rank, ``(rank - 3/8) / (n + 1/4)``, from positions in a range order, so nothing is sorted in one task; the
    statistic is their squared correlation. Ties may take their scores in any order, the sums are the same. The p-value is Royston's approximation, made for
    5 to 5,000 values; beyond, it is carried on. Nulls and NaN are left out; under 5 values or without spread both are null.
    """
    d = df.select(F.col(key).alias("_k"), F.col(value).cast("double").alias("_v")).filter("_v is not null and not isnan(_v)")
    d = with_position(d.withColumn("_row", F.monotonically_increasing_id()), ["_v", "_k", "_row"], "_pos")
    totals = d.agg(F.struct(F.count(F.lit(1)).alias("n"), F.avg("_v").alias("m"))).scalar()
    s = d.withColumn("_t", totals)
    score = special.norm_ppf((F.col("_pos") + 1 - 0.375) / (F.col("_t.n") + 0.25))
    x = F.col("_v") - F.col("_t.m")
    sums = s.withColumns({"_x": x, "_z": score}).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_x") * F.col("_z")).alias("xz"), F.sum(F.col("_x") * F.col("_x")).alias("xx"), F.sum(F.col("_z") * F.col("_z")).alias("zz"))
    enough = (F.col("n") >= 5) & (F.col("xx") > 0)
    sums = sums.select("n", F.when(enough, F.least(F.col("xz") * F.col("xz") / (F.col("xx") * F.col("zz")), F.lit(1.0))).alias("statistic"))
    u = F.ln(F.col("n"))
    v = F.ln(u)
    # fixed values: Royston's constants
    mean, sd = -1.2725 + 1.0521 * (v - u), 1.0308 - 0.26758 * (v + 2 / u)
    z = (F.ln(F.greatest(1 - F.col("statistic"), F.lit(1e-300))) - mean) / sd
    return sums.select("n", "statistic", F.when(F.col("statistic").isNotNull(), special.norm_sf(z)).alias("p_value"))


def normal_equations(df: DataFrame, x: Column, y: Column, degree: int) -> list[float]:
    """Polynomial least squares: power sums from one pass, a (degree+1)-square solve on the driver.

    The abscissa is standardised first, which keeps the small system well conditioned.
    Returns mean and spread of x followed by the coefficients, lowest power first.
    """
    import numpy as np

    s = df.agg(F.avg(x).alias("m"), F.stddev_pop(x).alias("s")).first()
    z = (x - F.lit(s["m"])) / F.lit(s["s"])
    sums = df.agg(*[F.sum(F.pow(z, F.lit(float(k)))).alias(f"p{k}") for k in range(2 * degree + 1)],
                  *[F.sum(F.pow(z, F.lit(float(k))) * y).alias(f"q{k}") for k in range(degree + 1)]).first()
    a = np.array([[sums[f"p{i + j}"] for j in range(degree + 1)] for i in range(degree + 1)])
    b = np.array([sums[f"q{i}"] for i in range(degree + 1)])
    return [s["m"], s["s"], *np.linalg.solve(a, b).tolist()]


def standardised_polynomial(x: Column, fit: Sequence[float]) -> Column:
    z = (x - F.lit(fit[0])) / F.lit(fit[1])
    out = F.lit(0.0)
    for c in reversed(fit[2:]):
        out = out * z + F.lit(c)
    return out
