"""Fits that run on partial sums against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.operators import learning as lr
from colonnade.operators import kernels, reshape, stats


def test_minibatch_step_by_step(spark):
    """Centres after every batch are those of the same steps in numpy, and the cost is near that of Lloyd's rounds on all rows."""
    rng = np.random.default_rng(1)
    x = np.vstack([c + rng.normal(scale=0.4, size=(150, 5)) for c in rng.normal(size=(6, 5)) * 4])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id long, v array<double>").repartition(4)
    batch = {r["id"]: r["b"] for r in df.select("id", lr.batch_of("id", 4).alias("b")).collect()}
    batch = np.array([batch[i] for i in range(len(x))])
    assert np.bincount(batch).min() > 150, "every batch has its share of the rows"
    start = x[[0, 160, 310, 460, 610, 760]]

    def plain(rounds, upto):
        centres, had = start.copy(), np.zeros(len(start))
        for step in range(rounds * 4):
            if step == upto:
                break
            own = x[batch == step % 4]
            near = ((own[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            for c in range(len(centres)):
                n = (near == c).sum()
                if n:
                    had[c] += n
                    centres[c] += n / had[c] * (own[near == c].mean(axis=0) - centres[c])
        return centres

    assert np.allclose(lr.minibatch(df, "id", F.col("v"), start.tolist(), 4, 1), plain(1, 4), atol=1e-9)
    got = np.array(lr.minibatch(df, "id", F.col("v"), start.tolist(), 4, 3))
    assert np.allclose(got, plain(3, 99), atol=1e-9)
    cost = lambda c: ((x[:, None] - np.asarray(c)[None]) ** 2).sum(axis=2).min(axis=1).sum()
    assert cost(got) <= 1.02 * cost(lr.lloyd(df, F.col("v"), start.tolist(), 20))


def test_polynomial_folds(spark):
    rng = np.random.default_rng(2)
    x, f = rng.uniform(1, 50, 600), rng.integers(0, 3, 600)
    y = np.sin(x / 6) * 10 + 0.2 * x + rng.normal(scale=1.0, size=600)
    rows = [(float(a), float(b), int(c)) for a, b, c in zip(x, y, f)] + [(None, 1.0, 0), (float("nan"), 1.0, 1), (3.0, None, 2)]
    got = {d: (a, b) for d, a, b in lr.polynomial_folds(spark.createDataFrame(rows, "x double, y double, f int").repartition(3), "x", "y", "f", 20)}
    assert sorted(got) == list(range(21))
    for degree in (0, 1, 3, 7, 12, 20):
        parts = []
        for k in range(3):
            fit = np.polynomial.Chebyshev.fit(x[f != k], y[f != k], degree, domain=[x.min(), x.max()])
            r2 = lambda m: 1 - ((y[m] - fit(x[m])) ** 2).sum() / ((y[m] - y[m].mean()) ** 2).sum()
            parts.append((r2(f != k), r2(f == k)))
        assert got[degree] == pytest.approx(np.mean(parts, axis=0), abs=1e-6)
    assert got[12][1] > 0.9 > got[1][1]
    assert lr.polynomial_folds(spark.createDataFrame([], "x double, y double, f int"), "x", "y", "f", 3) == []


def test_little_bootstraps(spark):
    """1,000 refits; errors near those of the formula, coefficients those of the plain fit."""
    rng = np.random.default_rng(3)
    n = 4000
    x = rng.normal(size=(n, 2))
    y = 3 + x @ [2.0, -1.0] + rng.normal(scale=2.0, size=n)
    rows = [(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))] + [(n, None, 1.0, 1.0), (n + 1, float("nan"), 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y double").repartition(5)
    plain, errors, refits = stats.little_bootstraps(df, "id", [F.lit(1.0), F.col("a"), F.col("b")], F.col("y"))
    design = np.column_stack([np.ones(n), x])
    want = np.linalg.lstsq(design, y, rcond=None)[0]
    formula = np.sqrt(np.diag(np.linalg.inv(design.T @ design)) * ((y - design @ want) ** 2).sum() / (n - 3))
    assert refits == 1000 and plain == pytest.approx(want, rel=1e-9) and errors == pytest.approx(formula, rel=0.15)
    assert stats.little_bootstraps(df, "id", [F.lit(1.0), F.col("a"), F.col("b")], F.col("y"))[1] == pytest.approx(errors, rel=1e-12), "the same draws again"
    assert stats.little_bootstraps(df.filter("false"), "id", [F.lit(1.0)], F.col("y")) == ([], [], 0)


def test_poisson_counts():
    draws = stats.poisson_counts(np.arange(2000), 100, 20.0)
    assert abs(draws.mean() - 20) < 0.1 and abs(draws.var() - 20) < 0.3 and abs(np.corrcoef(draws[:, 0], draws[:, 1])[0, 1]) < 0.08


@pytest.mark.parametrize("name", ["normal", "skewed", "ties", "few", "equal"])
def test_shapiro_francia(spark, name):
    from statistics import NormalDist

    rng = np.random.default_rng(4)
    x = {"normal": rng.normal(5, 2, 800), "skewed": rng.exponential(size=300), "ties": rng.integers(0, 6, 500).astype(float), "few": np.array([1.0, 2.0, 4.0]), "equal": np.ones(20)}[name]
    rows = [(i, float(v)) for i, v in enumerate(x)] + [(None, None), (-1, float("nan"))]
    r = stats.shapiro_francia(spark.createDataFrame(rows, "id long, v double").repartition(4), "id", "v").first()
    assert r["n"] == len(x)
    if name in ("few", "equal"):
        assert r["statistic"] is None and r["p_value"] is None
        return
    z = np.array([NormalDist().inv_cdf((i + 1 - 0.375) / (len(x) + 0.25)) for i in range(len(x))])
    w = np.corrcoef(np.sort(x), z)[0, 1] ** 2
    u = math.log(len(x))
    v = math.log(u)
    p = 1 - NormalDist(-1.2725 + 1.0521 * (v - u), 1.0308 - 0.26758 * (v + 2 / u)).cdf(math.log(1 - w))
    assert r["statistic"] == pytest.approx(w, rel=1e-9) and r["p_value"] == pytest.approx(p, rel=1e-5, abs=1e-12)
    assert (r["p_value"] > 0.01) == (name == "normal")


def test_values_become_columns(spark, monkeypatch):
    df = spark.createDataFrame([(1, ["b", "a"]), (2, ["c", None]), (3, None), (4, [])], "id long, w array<string>")
    out = reshape.indicator_columns(df, "w", ["id"])
    assert out.columns == ["id", "a", "b", "c"] and out.filter("id = 1").first()[1:] == (1, 1, 0)
    monkeypatch.setattr(reshape, "MOST_COLUMNS", 2)
    with pytest.raises(ValueError):
        reshape.indicator_columns(df, "w", ["id"])


def test_fourier_features_are_the_kernel(spark):
    x = np.random.default_rng(5).normal(size=(60, 6))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(60, None), (61, [1.0])], "id long, v array<double>")
    got = lr.fourier_features(df, "v", 6, 4000, 0.2).orderBy("id").collect()
    z = np.array([r["features"].toArray() for r in got])
    want = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert len(got) == 60 and np.abs(z @ z.T - want).max() < 0.12


def test_topic_chain(spark):
    """Weights, likelihoods and scores against the same chain in plain Python; a text without a known word gets the class of the highest prior."""
    docs = [(1, "a", "red apple red pear"), (2, "a", "apple tree"), (3, "b", "blue sky blue sea"), (4, "b", "sky and sea"), (5, "b", "sea"), (6, None, "no class")]
    model = lr.fit_topics(spark.createDataFrame(docs, "id long, c string, text string"), "id", "c", "text", 100, 0.1)
    known = [(i, c, t.split()) for i, c, t in docs if c]
    df = {w: sum(w in t for _, _, t in known) for _, _, t in known for w in t}
    idf = {w: math.log(6 / (1 + n)) + 1 for w, n in df.items()}

    def weigh(t):
        v = {w: t.count(w) * idf[w] for w in t if w in idf}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    total = {c: {w: sum(weigh(t).get(w, 0) for _, k, t in known if k == c) for w in df} for c in "ab"}
    lp = {c: {w: math.log((x + 0.1) / (sum(total[c].values()) + 0.1 * len(df))) for w, x in total[c].items()} for c in "ab"}
    prior = {"a": math.log(2 / 5), "b": math.log(3 / 5)}
    asked = [(10, "red apple sea"), (11, "sky"), (12, "unknown words only"), (13, None), (14, ""), (15, "apple apple blue")]
    got = {r["id"]: r for r in model.predict(spark.createDataFrame(asked, "id long, text string"), "id", "text").collect()}
    assert len(got) == 6
    for i, text in asked:
        score = {c: prior[c] + sum(x * lp[c][w] for w, x in weigh((text or "").split()).items()) for c in "ab"} if any(w in idf for w in (text or "").split()) else prior
        assert got[i]["prediction"] == max("ab", key=score.get) and got[i]["margin"] == pytest.approx(abs(score["a"] - score["b"]), abs=1e-9)


@pytest.mark.parametrize("width", [0.05, 1.0, 30.0])
def test_gaussian_sums(spark, width):
    """Within the stated bound of brute force, for places between, on and far from the values."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=1500), [100.0, -7.25, 0.5], np.full(300, 0.25)])
    c, n = rng.integers(0, 3, len(x)), rng.integers(1, 4, len(x))
    at = np.concatenate([rng.uniform(-5, 5, 200), [100.0, 1e6, 0.25, 50.0]])
    points = spark.createDataFrame([(int(a), float(b), int(k)) for a, b, k in zip(c, x, n)] + [(0, None, 1), (0, float("nan"), 1), (1, float("inf"), 1)], "c int, x double, n long")
    got = {(r["x"], r["c"]): r["s"] for r in kernels.gaussian_sums(points, spark.createDataFrame([(float(a),) for a in at] + [(None,)], "x double"), width).collect()}
    for a in at:
        for k in range(3):
            want = (n[c == k] * np.exp(-0.5 * ((a - x[c == k]) / width) ** 2)).sum()
            assert abs(got.get((float(a), k), 0.0) - want) <= kernels.ERROR * n.sum()


def test_many_distinct_values(spark):
    """A million distinct values: the sum at a few places is that of numpy."""
    d = spark.range(1_000_000).select(F.lit(0).alias("c"), (F.sin(F.col("id") * 0.7) * 10 + F.col("id") / 1e6).alias("x"), F.lit(1).alias("n"))
    i = np.arange(1_000_000)
    x = np.sin(i * 0.7) * 10 + i / 1e6
    for r in kernels.gaussian_sums(d, spark.createDataFrame([(0.0,), (9.5,)], "x double"), 0.4).collect():
        assert r["s"] == pytest.approx(np.exp(-0.5 * ((r["x"] - x) / 0.4) ** 2).sum(), rel=1e-9)


def exact_components(x, k):
    centred = x - x.mean(axis=0)
    _, size, directions = np.linalg.svd(centred, full_matrices=False)
    directions = directions[:k]
    sign = np.sign(directions[np.arange(len(directions)), np.abs(directions).argmax(axis=1)])
    return directions * sign[:, None], size[:k] ** 2 / (len(x) - 1), centred.var(axis=0, ddof=1).sum()


def test_components_of_64_dimensions(spark):
    """Even a flat spectrum: the span is complete, so directions, variances and scores are those of the whole decomposition."""
    x = np.random.default_rng(7).normal(size=(400, 64)) * np.linspace(1, 1.5, 64)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(-1, None), (-2, [1.0]), (-3, [float("nan")] * 64)], "id long, v array<double>").repartition(4)
    got = lr.wide_components(df, "v", 6)
    directions, variances, total = exact_components(x, 6)
    assert np.abs(got.directions - directions).max() < 1e-6 and got.variances == pytest.approx(variances, rel=1e-9) and got.total == pytest.approx(total, rel=1e-9)
    scores = {r["id"]: r["scores"] for r in got.project(df, "v").collect()}
    assert scores[-1] is None and scores[-2] is None and np.allclose([scores[i] for i in range(400)], (x - x.mean(axis=0)) @ directions.T, atol=1e-6)
    assert lr.wide_components(df.filter("false"), "v", 3).directions.size == 0


def test_components_of_wide_vectors(spark):
    """10,000 entries, six strong directions over noise: found without a matrix of 100 million moments."""
    rng = np.random.default_rng(8)
    strong = np.linalg.qr(rng.normal(size=(10_000, 6)))[0].T
    x = (rng.normal(size=(120, 6)) * [60, 50, 40, 30, 25, 20]) @ strong + rng.normal(scale=0.05, size=(120, 10_000))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, v array<double>").repartition(4)
    got = lr.wide_components(df, "v", 6, extra=4, rounds=4)
    directions, variances, total = exact_components(x, 6)
    assert got.variances == pytest.approx(variances, rel=1e-6) and np.abs(got.directions - directions).max() < 1e-5 and got.total == pytest.approx(total, rel=1e-6)
