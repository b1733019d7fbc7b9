"""Nearest vectors in many dimensions against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colonnade.operators import vectors


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), None if r is None else [None if c is None else float(c) for c in r]) for i, r in zip(ids, x)], "id long, v array<double>").repartition(4)


def brute(x, k):
    out = {}
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        out[i] = np.lexsort((np.arange(len(x)), d))[: min(k, len(x) - 1)].tolist()
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        out.setdefault(r["id"], []).append(r["neighbour"])
    return out


def cases():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 3
    yield "clusters", np.vstack([c + rng.normal(scale=0.3, size=(25, 16)) for c in centres])
    yield "no structure", rng.normal(size=(250, 24))
    yield "copies and a lone vector", np.vstack([np.tile(rng.normal(size=(1, 8)), (120, 1)), rng.normal(size=(60, 8)), [[500.0] * 8]])
    yield "a dense cluster", np.vstack([rng.normal(scale=1e-3, size=(200, 6)), rng.normal(size=(30, 6)) * 10])
    yield "fewer than k", rng.normal(size=(3, 5))
    yield "one", rng.normal(size=(1, 5))
    yield "equal", np.ones((20, 4))


@pytest.mark.parametrize("name,x", list(cases()))
def test_knn_join(spark, name, x):
    got = lists(vectors.knn_join(frame(spark, x), "id", "v", 4, references=6, block=16))
    want = {i: o for i, o in brute(x, 4).items() if o}
    assert got == want


def test_distances_ranks_and_unusable_vectors(spark):
    x = np.random.default_rng(2).normal(size=(40, 3))
    odd = [None, [], [float("nan")] * 3, [None, 1.0, 2.0], [float("inf"), 0.0, 0.0]]
    got = vectors.knn_join(frame(spark, [*x, *odd]), "id", "v", 3, block=8).collect()
    assert {r["id"] for r in got} == set(range(40)) and {r["rank"] for r in got} == {1, 2, 3} and {r["neighbour"] for r in got} <= set(range(40))
    assert all(r["dist"] == pytest.approx(np.linalg.norm(x[r["id"]] - x[r["neighbour"]])) for r in got)
    for find in (vectors.knn_join, vectors.knn_hyperplanes):
        empty = find(frame(spark, x).filter("false"), "id", "v", 3)
        assert empty.count() == 0 and empty.columns == ["id", "rank", "neighbour", "dist"]


def test_blocks_stay_closed(spark, monkeypatch):
    """Clusters far from each other: few of all pairs of blocks are compared."""
    rng = np.random.default_rng(3)
    x = np.vstack([c + rng.normal(scale=0.05, size=(100, 8)) for c in rng.normal(size=(16, 8)) * 10])
    compared, plain = [], vectors._compare

    def counting(pairs, dim, k):
        compared.append(pairs.count())
        return plain(pairs, dim, k)

    monkeypatch.setattr(vectors, "_compare", counting)
    got = lists(vectors.knn_join(frame(spark, x), "id", "v", 5, references=16, block=25))
    assert got == brute(x, 5) and sum(compared) < 0.2 * (len(x) / 25) ** 2


@pytest.mark.parametrize("n,kind", [(3000, "clusters"), (3000, "no structure")])
def test_hyperplanes_recall(spark, n, kind):
    """Recall at 5 in 64 dimensions for ids divisible by 20 against all rows; a third of the rows are copies of one vector."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(n, 64)) if kind == "no structure" else rng.normal(size=(60, 64))[rng.integers(0, 60, n)] + rng.normal(scale=0.4, size=(n, 64))
    x[rng.permutation(n)[: n // 3]] = x[0]
    # buckets as full as they would be far beyond this size hold more rows than a block, so they are dealt in parts
    got = lists(vectors.knn_hyperplanes(frame(spark, x), "id", "v", 5, F.col("id") % 20 == 0))
    assert set(got) == set(range(0, n, 20))
    hits = []
    for i in got:
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        reach = np.sort(d)[4] * (1 + 1e-12)
        hits += [d[j] <= reach for j in got[i]] + [False] * (5 - len(got[i]))
    assert np.mean(hits) >= 0.9


def test_hyperplanes_on_the_table(spark, sf_dir):
    from colonnade.tables import Tables

    e = Tables(spark, sf_dir).embeddings
    got = lists(vectors.knn_hyperplanes(e, "vec_id", "embedding", 5, F.col("vec_id") % 20 == 0))
    rows = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    hit = []
    for i in got:
        want = sorted((float(((rows[i] - v) ** 2).sum()), j) for j, v in rows.items() if j != i)[:5]
        hit.append(len({j for _, j in want} & set(got[i])) / 5)
    assert set(got) == {i for i in rows if i % 20 == 0} and np.mean(hit) >= 0.9


def test_blocks_travel_by_groups(spark, monkeypatch):
    """Each pair of blocks carried both blocks through the shuffle, which grew with the square of the rows."""
    x = np.random.default_rng(8).normal(size=(300, 6))
    seen, plain = [], vectors._compare

    def looking(pairs, dim, k):
        seen.append(pairs)
        return plain(pairs, dim, k)

    monkeypatch.setattr(vectors, "_compare", looking)
    monkeypatch.setattr(vectors, "GROUP_BYTES", 1000)  # fifteen groups
    assert lists(vectors.knn_join(frame(spark, x), "id", "v", 4, references=6, block=16)) == brute(x, 4)
    assert len(seen) == 2 and all("xs" not in p.pairs.columns for p in seen) and seen[0].blocks.select("g").distinct().count() > 8
