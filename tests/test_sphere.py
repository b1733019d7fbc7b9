"""Nearest facilities on the globe against brute force: date line, poles, crowds, lone places."""

import numpy as np
import pandas as pd
import pytest

from colonnade.operators import sphere


def km(lat, lon, flat, flon):
    rad = np.radians
    h = np.sin(rad(flat - lat) / 2) ** 2 + np.cos(rad(lat)) * np.cos(rad(flat)) * np.sin(rad(flon - lon) / 2) ** 2
    return 2 * 6371 * np.arcsin(np.sqrt(np.minimum(h, 1)))


def globe(rng, n):
    return np.column_stack([np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)])


def cases():
    rng = np.random.default_rng(2)
    near = lambda lat, lon, n, s: np.column_stack([np.clip(lat + rng.normal(scale=s, size=n), -90, 90), (lon + rng.normal(scale=s, size=n) + 180) % 360 - 180])
    yield "everywhere", globe(rng, 300), globe(rng, 60)
    yield "longitude 180", near(10, 180, 150, 2), near(10, -179.5, 80, 2)
    yield "latitude 88", np.column_stack([rng.uniform(86, 90, 150), rng.uniform(-180, 180, 150)]), np.column_stack([rng.uniform(87, 90, 60), rng.uniform(-180, 180, 60)])
    yield "the poles", np.array([[90.0, 0], [90, 77], [-90, 3], [-89.999, -180], [89.9999, 180], [-88, 90]]), np.array([[89.0, 100], [88.5, -80], [-89.5, 10], [-89.5, -170], [0.0, 0]])
    yield "a crowd far from lone places", np.vstack([near(40, 30, 100, 0.2), globe(rng, 30), [[-40.0, -150.0]]]), near(40, 30, 1500, 0.3)
    yield "one facility", globe(rng, 40), np.array([[12.0, 179.999]])
    yield "corners of the cube", np.degrees(np.array([[s * np.arctan(np.sqrt(0.5)), o] for s in (-1, 1) for o in (np.pi / 4, 3 * np.pi / 4, -np.pi / 4, -3 * np.pi / 4)])), globe(rng, 200)


@pytest.mark.parametrize("name,p,f", list(cases()))
def test_nearest_facility(spark, name, p, f):
    p, f = (pd.DataFrame({"id": np.arange(len(x)), "lat": x[:, 0].astype(float), "lon": x[:, 1].astype(float)}) for x in (p, f))
    got = sphere.nearest_facility(spark.createDataFrame(p), spark.createDataFrame(f), crowd=32).toPandas().set_index("id").sort_index()
    assert got.index.tolist() == p["id"].tolist()
    for i, lat, lon in p.itertuples(index=False):
        d = km(lat, lon, f["lat"], f["lon"])
        assert got.loc[i, "km"] == pytest.approx(d.min(), abs=1e-7) and d[got.loc[i, "facility"]] == pytest.approx(d.min(), abs=1e-7)


def test_repeated_and_missing_positions(spark):
    rows = [(1, 10.0, 20.0), (2, 10.0, 20.0), (3, None, 5.0), (4, 10.0, float("nan")), (5, -10.0, -20.0)]
    places = spark.createDataFrame(rows, "id long, lat double, lon double")
    stations = spark.createDataFrame([(9, 10.5, 20.0), (7, 10.5, 20.0), (8, 9.5, 20.0), (None, 10.0, 20.0), (6, None, None)], "id long, lat double, lon double")
    got = {r["id"]: (r["facility"], round(r["km"], 6)) for r in sphere.nearest_facility(places, stations).collect()}
    assert set(got) == {1, 2, 5} and got[1] == got[2] and got[1][0] in (7, 8) and got[1][1] == pytest.approx(km(10, 20, 10.5, 20.0), abs=1e-4)
    assert sphere.nearest_facility(places, stations.filter("false")).count() == 0 and sphere.nearest_facility(places.filter("false"), stations).count() == 0


def test_coverings_hold_the_cap(spark):
    """Every position of a cap lies in one of the cells of its covering."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = []
    for k, (lat, lon) in enumerate([*globe(rng, 30), (90, 0), (-90, 0), (0, 180), (35.2644, 45), (0, 45)]):
        radius = float(rng.choice([0.01, 0.1, 0.5, 1.2, 2.0, 3.0]))
        for a, b in globe(rng, 200):
            if km(lat, lon, a, b) / 6371 <= radius:
                rows.append((k, float(lat), float(lon), radius, float(a), float(b)))
    df = spark.createDataFrame(rows, "k int, lat double, lon double, radius double, a double, b double").withColumn("level", F.lit(4))
    df = df.withColumns(sphere.unit(F.col("lat"), F.col("lon"))).withColumn("cells", sphere.covering((F.col("x0"), F.col("x1"), F.col("x2")), F.col("radius"), F.col("level")))
    df = df.withColumns({f"y{c}": v for c, v in zip("012", sphere.unit(F.col("a"), F.col("b")).values())}).withColumns(sphere.home((F.col("y0"), F.col("y1"), F.col("y2"))))
    inside = F.exists("cells", lambda c: (c["face"] == F.col("face")) & (c["i"] == sphere.cell(F.col("u"), 4)) & (c["j"] == sphere.cell(F.col("v"), 4)))
    assert len(rows) > 500 and df.filter(~inside).count() == 0
