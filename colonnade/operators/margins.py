"""Linear margin classifiers, one against the rest, for a whole grid of settings at once.

Every setting and class is a model of its own with the hinge loss and an L2 penalty, fitted as ``LinearSVC`` fits it: features
scaled to unit deviation around their mean, orthant-wise L-BFGS from zero, backtracking steps under the strong Wolfe conditions, the first of a search always cut.
The optimisers hold a few vectors of the size of a model on the driver and advance side by side: what they all ask for next is
answered by one pass over the rows, a matrix product a batch, so the passes do not grow with the number of models.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Generator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Steps that L-BFGS remembers; steps of one line search; bounds of a step's length.
_MEMORY, _TRIES, _SHORTEST, _LONGEST = 10, 20, 1e-10, 1e10
_ARMIJO, _WOLFE = 1e-4, 0.9
#: Rows of a matrix product.
_ROWS = 2048


class _Failed(Exception):
    pass


def _direction(history: deque, grad: np.ndarray) -> np.ndarray:
    """The two-loop recursion; components against the gradient's sign are dropped."""
    d, used = grad.copy(), []
    for step, change in history:
        rho = step @ change
        with np.errstate(all="ignore"):
            a = (step @ d) / rho
        if np.isnan(a):
            raise _Failed
        used.append((step, change, rho, a))
        d = d - a * change
    if history:
        step, change = history[0]
        sy = step @ change
        if sy < 0 or np.isnan(sy):
            raise _Failed
        d = d * (sy / (change @ change))
    for step, change, rho, a in reversed(used):
        d = d + (a - (change @ d) / rho) * step
    d = -d
    return np.where(d * grad < 0, d, 0.0)


def _minimise(size: int, rounds: int, tol: float) -> Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]:
    """Yields points, is sent their value and gradient, and returns the minimum found in ``rounds`` steps."""
    x = np.zeros(size)
    value, grad = yield x
    first, values, history, failed, done = value, [value], deque(maxlen=_MEMORY), False, 0
    while done < rounds and not np.linalg.norm(grad) <= max(tol * abs(value), 1e-8) and not (len(values) > 1 and abs(value - max(values)) <= tol * first):
        try:
            d = _direction(history, grad)
            orthant = np.where(x != 0, np.sign(x), np.sign(-grad))

            def moved(a, x=x, d=d, orthant=orthant):
                to = x + a * d
                return np.where(np.sign(to) == orthant, to, 0.0)

            slope, a, shrink = grad @ d, 1.0 if done else 0.5 / np.linalg.norm(grad), 0.5 if done else 0.1
            tries, now, kept = 0, None, None
            while True:
                # the first length is judged by the old value, so it is always cut and need not be tried
                if now is None and value > value + a * slope * _ARMIJO:
                    factor = shrink
                else:
                    if now is None:
                        new = moved(a)
                        now = (new, *(yield new))
                        kept = now
                    pull = now[2] @ d
                    if tries and now[1] > value + a * slope * _ARMIJO:
                        factor = shrink
                    elif pull < _WOLFE * slope:
                        factor = 2.1
                    elif pull > -_WOLFE * slope:
                        factor = shrink
                    else:
                        break
                a *= factor
                if not _SHORTEST <= a <= _LONGEST:
                    raise _Failed
                new, tries = moved(a), tries + 1
                before, now = now, (new, *(yield new))
                if tries == _TRIES:
                    kept = before
                    break
                kept = now
            new, new_value, new_grad = kept
            history.appendleft((new - x, new_grad - grad))
            x, value, grad, failed, done = new, new_value, new_grad, False, done + 1
            values.append(value)
        except _Failed:
            if failed:
                break
            failed = True
            history.clear()
    return x


@dataclass
class MarginGrid:
    """Per setting a matrix of classes x features (zero beyond the setting's features) and the intercepts of the classes."""

    settings: list[tuple[int, float]]
    weights: np.ndarray  # setting, class, feature
    intercepts: np.ndarray  # setting, class

    def predict(self, df: DataFrame, vector: str, keep: Sequence[str]) -> DataFrame:
        """The columns ``keep`` and ``predictions``: the class of largest margin under every setting, the first in order if several are."""
        import pyarrow as pa

        count, classes, dim = self.weights.shape
        flat, shift = self.weights.reshape(-1, dim).T, self.intercepts.reshape(-1)

        def run(batches):
            for b in batches:
                x = b.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                best = (x @ flat + shift).reshape(len(x), count, classes).argmax(axis=2).astype(float)
                lists = pa.ListArray.from_arrays(np.arange(0, best.size + 1, count, dtype=np.int32), pa.array(best.ravel()))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), lists], [*keep, "predictions"])

        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        return df.select(*keep, vector).mapInArrow(run, ", ".join([*(f"`{c}` {types[c]}" for c in keep), "predictions array<double>"]))

    def accuracies(self, df: DataFrame, vector: str, label: str) -> list[float]:
        """The share of right predictions of every setting, from one pass."""
        p = self.predict(df, vector, [label])
        hits = p.agg(*[F.avg((F.get("predictions", F.lit(i)) == F.col(label)).cast("double")) for i in range(len(self.settings))]).first()
        return list(hits)


def fit_margin_grid(df: DataFrame, vector: str, label: str, settings: Sequence[tuple[int, float]], rounds: int, tol: float = 1e-6) -> MarginGrid:
    """Fit all ``settings``, pairs of the number of leading features and the penalty, on ``df``: ``vector`` (array of double, one length)
    and ``label`` (0, 1, ...). Hold ``df`` before: it is read once for each step of the slowest model. Sums of the size of the models reach the driver.
    """
    import pyarrow as pa

    settings = list(settings)
    top, dim = df.agg(F.max(label), F.max(F.size(vector))).first()
    classes, models = int(top) + 1, len(settings) * (int(top) + 1)
    long = df.select(F.posexplode(vector).alias("j", "v")).groupBy("j").agg(F.avg("v").alias("m"), F.coalesce(F.stddev("v"), F.lit(0.0)).alias("s"), F.count(F.lit(1)).alias("n"))
    mean, spread, rows = np.zeros(dim), np.zeros(dim), 0
    for r in long.collect():
        mean[r["j"]], spread[r["j"]], rows = r["m"], r["s"], r["n"]
    scale = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0)

    def losses(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Mean loss and its gradient of every model at its point (features, then the intercept), from one pass."""
        w, shift = points[:, :dim].T, points[:, dim]

        def run(batches):
            total = np.zeros((models, dim + 2))
            for b in batches:
                for at in range(0, b.num_rows, _ROWS):
                    part = b.slice(at, _ROWS)
                    x = (part.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) - mean) * scale
                    own = part.column(label).to_numpy(zero_copy_only=False).astype(int)
                    sign = np.where(own[:, None] == np.arange(classes), 1.0, -1.0)
                    sign = np.tile(sign, (1, len(settings)))
                    gap = 1 - sign * (x @ w + shift)
                    pull = np.where(gap > 0, -sign, 0.0)
                    total[:, :dim] += pull.T @ x
                    total[:, dim] += pull.sum(axis=0)
                    total[:, dim + 1] += np.maximum(gap, 0).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(models, dtype=np.int32)), pa.array(total.tolist(), pa.list_(pa.float64()))], ["m", "s"])

        parts = df.select(vector, label).mapInArrow(run, "m int, s array<double>")
        out = np.zeros((models, dim + 2))
        for r in parts.groupBy("m").agg(*[F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(dim + 2)]).collect():
            out[r["m"]] = r[1:]
        return out[:, dim + 1] / rows, out[:, : dim + 1] / rows

    used = [k for k, _ in settings for _ in range(classes)]
    penalty = [reg for _, reg in settings for _ in range(classes)]
    runs = [_minimise(k + 1, rounds, tol) for k in used]
    asked, found = {i: next(g) for i, g in enumerate(runs)}, {}
    points = np.zeros((models, dim + 1))
    while asked:
        for i, x in asked.items():
            points[i, : used[i]], points[i, dim] = x[:-1], x[-1]
        loss, grad = losses(points)
        for i, x in list(asked.items()):
            own = np.append(grad[i, : used[i]] + penalty[i] * x[:-1], grad[i, dim])
            try:
                asked[i] = runs[i].send((loss[i] + 0.5 * penalty[i] * (x[:-1] @ x[:-1]), own))
            except StopIteration as end:
                found[i] = end.value
                del asked[i]
    weights, intercepts = np.zeros((models, dim)), np.zeros(models)
    for i, x in found.items():
        weights[i, : used[i]] = x[:-1] * scale[: used[i]]
        intercepts[i] = x[-1] - weights[i] @ mean
    return MarginGrid(settings, weights.reshape(len(settings), classes, dim), intercepts.reshape(len(settings), classes))
