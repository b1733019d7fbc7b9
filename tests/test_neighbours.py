"""Neighbour search against brute force: copies, a dense cluster far from lone points, few points."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from colonnade.operators import neighbours as nb


def _brute(pdf, k):
    out = {}
    for i, x, y in pdf.itertuples(index=False):
        d = np.sqrt((pdf.x - x) ** 2 + (pdf.y - y) ** 2)
        o = pdf.assign(d=d)[pdf.id != i].sort_values(["d", "id"]).head(k)
        out[i] = o["id"].tolist()
    return out


def _cases():
    rng = np.random.default_rng(1)
    yield "uniform", rng.random((300, 2))
    yield "copies", np.vstack([np.tile([[0.3, 0.3]], (120, 1)), rng.random((120, 2))])
    yield "cluster", np.vstack([rng.normal(0, 1e-4, (150, 2)), rng.uniform(-50, 50, (20, 2)), [[1000.0, 1000.0]]])
    yield "few", rng.random((3, 2))
    yield "line", np.column_stack([np.arange(60.0), np.zeros(60)])


@pytest.mark.parametrize("name,xy", list(_cases()))
def test_knn(spark, name, xy):
    pdf = pd.DataFrame({"id": np.arange(len(xy)), "x": xy[:, 0], "y": xy[:, 1]})
    got = nb.knn(spark.createDataFrame(pdf), "id", F.col("x"), F.col("y"), 4).toPandas().sort_values(["id", "rank"])
    assert got.groupby("id")["neighbour"].apply(list).to_dict() == _brute(pdf, 4)


def test_crowded_cells_are_dealt_in_parts(spark, monkeypatch):
    monkeypatch.setattr(nb, "CROWD", 5)
    test_knn(spark, *list(_cases())[2])
