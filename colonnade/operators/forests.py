"""A random forest for a numeric label that grows on bins, not on rows.

A tree sees a row only through the bins of its features, so all it needs of its bootstrap sample are the weight, the sum of the
label and the sum of its squares for each combination of bins (a cell). One pass over the rows draws the samples of all trees and
sums them by cell; what follows works on cells, whose number is bounded by the product of the numbers of bins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Quantiles that splits are chosen from; rows drawn from at once; numbers of a task's sums before they are handed on.
QUANTILES, ROWS, HELD = 1000, 1 << 17, 1 << 24


def split_points(df: DataFrame, features: Sequence[str], bins: int) -> list[np.ndarray]:
    """Per feature up to ``bins - 1`` thresholds: between all its values if they are few, else at about equal shares of the rows."""
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, 10 * QUANTILES).alias(f"q{i}") for i, c in enumerate(features)]).first()
    out = []
    for q in row:
        values, counts = np.unique(np.array(q if q is not None else [0.0]), return_counts=True)
        middles = (values[:-1] + values[1:]) / 2
        if len(middles) >= bins:
            reached = np.cumsum(counts)[:-1]
            at = np.searchsorted(reached, counts.sum() * np.arange(1, bins) / bins)
            middles = middles[np.unique(np.minimum(at, len(middles) - 1))]
        out.append(middles)
    return out


def _cells(batch: pa.RecordBatch, features: Sequence[str], points: list[np.ndarray]) -> np.ndarray:
    code = np.zeros(batch.num_rows, np.int64)
    for c, p in zip(features, points):
        code = code * (len(p) + 1) + np.searchsorted(p, batch.column(c).to_numpy(zero_copy_only=False).astype(float), side="left")
    return code


def _bins(cells: np.ndarray, points: list[np.ndarray]) -> np.ndarray:
    """The bins (rows x features) of cells."""
    out = []
    for p in reversed(points):
        cells, b = np.divmod(cells, len(p) + 1)
        out.append(b)
    return np.stack(out[::-1], axis=1)


def _grow(bins: np.ndarray, sums: np.ndarray, sizes: Sequence[int], depth: int, tried: int, rng: np.random.Generator) -> list[tuple]:
    """One tree as ``(feature, bin, left, right, value)`` by node, feature -1 in a leaf: the split of largest variance reduction among ``tried`` features of a node."""
    nodes, todo = [], [(np.arange(len(bins)), 0)]
    links = [None]
    while todo:
        rows, level = todo.pop(0)
        at = len(nodes)
        if links[at] is not None:
            parent, side = links[at]
            nodes[parent][side] = at
        w, s, q = sums[rows].sum(axis=0)
        nodes.append([-1, 0, 0, 0, float(s / w) if w else 0.0])
        impurity, best = (q - s * s / w if w else 0.0), (0.0, None, None)
        if level == depth or w < 2 or impurity <= 0:
            continue
        for f in sorted(rng.choice(len(sizes), tried, replace=False)):
            h = np.stack([np.bincount(bins[rows, f], sums[rows, i], sizes[f]) for i in range(3)], axis=1)
            left = np.cumsum(h, axis=0)[:-1]
            right = np.array([w, s, q]) - left
            fine = (left[:, 0] >= 1) & (right[:, 0] >= 1)
            with np.errstate(all="ignore"):
                gain = np.where(fine, left[:, 1] ** 2 / left[:, 0] + right[:, 1] ** 2 / right[:, 0] - s * s / w, -1.0)
            if len(gain) and gain.max() > max(best[0], 1e-12 * abs(q)):
                best = (gain.max(), int(f), int(gain.argmax()))
        if best[1] is not None:
            nodes[at][0], nodes[at][1] = best[1], best[2]
            goes = bins[rows, best[1]] <= best[2]
            for side, part in ((2, rows[goes]), (3, rows[~goes])):
                links.append((at, side))
                todo.append((part, level + 1))
    return [tuple(n) for n in nodes]


@dataclass
class Forest:
    """Thresholds by feature, and per tree its nodes ``(feature, bin, left, right, value)``."""

    features: list[str]
    points: list[np.ndarray]
    trees: list[list[tuple]]

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the mean of all trees, which are asked once for each cell; null where a feature is null."""
        features, points = self.features, self.points
        trees = [(np.array([n[:4] for n in t], np.int64), np.array([n[4] for n in t])) for t in self.trees]

        @F.arrow_udf(LongType())
        def cell(*columns):
            known = np.logical_and.reduce([c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
            return pa.array(_cells(pa.RecordBatch.from_arrays(list(columns), features), features, points), mask=~known)

        def mean(batches):
            for b in batches:
                bins = _bins(b.column("_cell").to_numpy(), points)
                total, row = np.zeros(len(bins)), np.arange(len(bins))
                for nodes, values in trees:
                    at = np.zeros(len(bins), np.int64)
                    while (inner := nodes[at, 0] >= 0).any():
                        at = np.where(inner, np.where(bins[row, nodes[at, 0]] <= nodes[at, 1], nodes[at, 2], nodes[at, 3]), at)
                    total += values[at]
                yield pa.RecordBatch.from_arrays([b.column("_cell"), pa.array(total / len(trees))], ["_cell", out])

        coded = df.withColumn("_cell", cell(*[F.col(c).cast("double") for c in features]))
        asked = coded.select("_cell").filter("_cell is not null").distinct()
        return coded.join(asked.mapInArrow(mean, f"_cell long, `{out}` double"), "_cell", "left").drop("_cell")


def fit_forest(df: DataFrame, features: Sequence[str], label: str, trees: int, depth: int, bins: int = 32, seed: int = 1) -> Forest:
    """Fit ``trees`` regression trees of ``depth`` on bootstrap samples of all rows of ``df``, a third of the features tried at a node.

    The samples are drawn row by row with replacement, seeded by the partition. Rows with a null label or feature are refused. Every tree
    grows in one task from its cells; only the finished trees reach the driver.
    """
    features = list(features)
    d = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"))
    names = d.columns[:-1]
    missing = F.count_if(F.greatest(*[F.col(c).isNull() for c in d.columns]))
    rows, bad = d.agg(F.count(F.lit(1)), missing).first()
    if bad or not rows:
        raise ValueError(f"{bad} of {rows} rows have a null label or feature" if bad else "no rows to learn from")
    points = split_points(d, names, bins)
    sizes = [len(p) + 1 for p in points]
    tried = -(-len(names) // 3)

    def draw(batches):
        from pyspark import TaskContext

        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        known, parts = np.zeros(0, np.int64), np.zeros((trees, 0, 3))

        def handed():
            for t in range(trees):
                some = parts[t, :, 0] > 0
                if some.any():
                    cols = [np.full(some.sum(), t, np.int32), known[some], *parts[t, some].T]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], ["tree", "cell", "w", "s", "q"])

        def pooled():
            """Cells and labels of many batches at a time, in the order of the cells."""
            held, n = [], 0
            for b in batches:
                held.append((_cells(b, names, points), b.column("y").to_numpy(zero_copy_only=False).astype(float)))
                n += b.num_rows
                if n >= ROWS:
                    yield [np.concatenate(x) for x in zip(*held)]
                    held, n = [], 0
            if n:
                yield [np.concatenate(x) for x in zip(*held)]

        for cells, y in pooled():
            order = np.argsort(cells, kind="stable")
            cells, y = cells[order], y[order]
            starts = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1))
            own, y2 = cells[starts], y * y
            union = np.union1d(known, own)
            if len(union) > len(known):
                if union.size * trees * 3 > HELD and len(known):
                    yield from handed()
                    known, parts, union = np.zeros(0, np.int64), np.zeros((trees, 0, 3)), own
                wider = np.zeros((trees, len(union), 3))
                wider[:, np.searchsorted(union, known)] = parts
                known, parts = union, wider
            at = np.searchsorted(known, own)
            for t in range(trees):
                # as many draws as Poisson says, each of any row: every row's count is then Poisson with mean one, on its own
                w = np.bincount(rng.integers(0, len(y), rng.poisson(len(y)), dtype=np.int32), minlength=len(y)).astype(float)
                parts[t, at] += np.stack([np.add.reduceat(x, starts) for x in (w, w * y, w * y2)], axis=1)
        yield from handed()

    drawn = d.mapInArrow(draw, "tree int, cell long, w double, s double, q double")
    summed = drawn.groupBy("tree", "cell").agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.sum("q").alias("q"))

    def grow(table: pa.Table) -> pa.Table:
        col = lambda n: table.column(n).to_numpy()
        order, t = np.argsort(col("cell")), int(col("tree")[0])
        sums = np.stack([col(n)[order] for n in "wsq"], axis=1)
        nodes = _grow(_bins(col("cell")[order], points), sums, sizes, depth, tried, np.random.default_rng([seed, 1 << 20, t]))
        cols = [pa.array([t] * len(nodes), pa.int32()), pa.array(range(len(nodes)), pa.int32()), *(pa.array([n[i] for n in nodes], pa.int32() if i < 4 else pa.float64()) for i in range(5))]
        return pa.table(cols, names=["tree", "node", "feature", "bin", "lower", "upper", "value"])

    grown = summed.groupBy("tree").applyInArrow(grow, "tree int, node int, feature int, bin int, lower int, upper int, value double")
    found: dict[int, list] = {}
    for r in sorted(grown.collect(), key=lambda r: (r["tree"], r["node"])):
        found.setdefault(r["tree"], []).append((r["feature"], r["bin"], r["lower"], r["upper"], r["value"]))
    return Forest(features, points, [found[t] for t in sorted(found)])
