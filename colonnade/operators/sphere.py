"""Nearest places on the globe, with cells on the faces of a cube around it.

Positions are unit vectors; a cell is a square of two angles on one of six faces, so there is no date line and no pole:
a cap of any radius is covered by the cells that its angles reach on each face it touches. Facilities met just before and
after a place on the curve through the cells bound its radius, which sets the size of the cells it looks into. A
cell that holds many facilities is not read as one: those who look into it go on to its sixteen parts, with a radius that the
parts' first facilities shrink, and leave the parts out that lie beyond it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.functions.geo import EARTH_KM, haversine
from colonnade.operators.ordered import running
from colonnade.session import checkpoint_root

#: Levels of cells: an edge is a quarter turn over ``2 ** level``; deeper by ``STEP`` where a cell holds more than ``CROWD``.
DEEPEST, STEP, CROWD = 24, 2, 256
_QUARTER, _SLACK = math.pi / 2, 1 + 1e-9


def unit(lat: Column, lon: Column) -> dict[str, Column]:
    """Position as a unit vector ``x0``, ``x1``, ``x2``."""
    a, b = F.radians(lat), F.radians(lon)
    return {"x0": F.cos(a) * F.cos(b), "x1": F.cos(a) * F.sin(b), "x2": F.sin(a)}


def _on_face(face: int, x: tuple[Column, Column, Column]) -> tuple[Column, Column, Column]:
    """Components along a face's outward normal and its two edges; face ``2 * axis + (1 for the negative side)``."""
    axis, side = divmod(face, 2)
    return (-x[axis] if side else x[axis]), x[(axis + 1) % 3], x[(axis + 2) % 3]


def home(x: tuple[Column, Column, Column]) -> dict[str, Column]:
    """``face`` and ``u``, ``v``: the face that a position lies on and its two angles there, from 0 to 1."""
    size = [F.abs(c) for c in x]
    axis = F.when((size[0] >= size[1]) & (size[0] >= size[2]), 0).when(size[1] >= size[2], 1).otherwise(2)
    coordinate = F.when(axis == 0, x[0]).when(axis == 1, x[1]).otherwise(x[2])
    face = 2 * axis + F.when(coordinate < 0, 1).otherwise(0)
    place = lambda k: F.coalesce(*[F.when(face == f, F.atan2(_on_face(f, x)[k], _on_face(f, x)[0])) for f in range(6)])
    return {"face": face.cast("int"), "u": place(1) / _QUARTER + 0.5, "v": place(2) / _QUARTER + 0.5}


def cell(coordinate: Column, level: Column | int) -> Column:
    """Number of the cell along an edge."""
    n = F.shiftleft(F.lit(1).cast("long"), level) if isinstance(level, int) else F.pow(F.lit(2.0), level).cast("long")
    return F.least(F.greatest(F.floor(coordinate * n), F.lit(0).cast("long")), n - 1)


def _interleave(a: Column, b: Column) -> Column:
    """Place on the curve through the cells of a face."""
    def wide(v: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return wide(a).bitwiseOR(F.shiftleft(wide(b), 1))


def covering(q: tuple[Column, Column, Column], radius: Column, level: Column) -> Column:
    """Cells (``face``, ``i``, ``j``) of a level that a cap (angle ``radius`` around ``q``) may reach, as an array of structs.

    On a face, a cap reaches as far along an edge as it would in longitude if the other edge's axis were the pole:
    the whole way if it holds that axis, else by the arcsine of its radius over the distance to that axis.
    """
    out = []
    for face in range(6):
        n, a, b = _on_face(face, q)

        def reach(along: Column) -> tuple[Column, Column]:
            far = F.sqrt(along * along + n * n)
            middle = F.atan2(along, n)
            open_ = (radius >= _QUARTER) | (far <= F.sin(radius))
            half = F.when(open_, F.lit(math.pi * 2)).otherwise(F.asin(F.least(F.sin(radius) / F.greatest(far, F.lit(1e-300)), F.lit(1.0)))) + 1e-12
            return F.greatest(middle - half, F.lit(-_QUARTER / 2)), F.least(middle + half, F.lit(_QUARTER / 2))

        (lo_u, hi_u), (lo_v, hi_v) = reach(a), reach(b)
        steps = lambda lo, hi: F.sequence(cell(lo / _QUARTER + 0.5, level), cell(hi / _QUARTER + 0.5, level))
        cells = F.flatten(F.transform(steps(lo_u, hi_u), lambda i: F.transform(steps(lo_v, hi_v), lambda j: F.struct(F.lit(face).alias("face"), i.alias("i"), j.alias("j")))))
        out.append(F.when((lo_u <= hi_u) & (lo_v <= hi_v), cells).otherwise(F.expr("cast(array() as array<struct<face:int,i:bigint,j:bigint>>)")))
    return F.concat(*out)


def _least_angle(q: tuple[Column, Column, Column], face: Column, i: Column, j: Column, level: int) -> Column:
    """A lower bound of the angle between a position and a cell: to the cell's middle, less its edge (its half diagonal is smaller)."""
    edge = _QUARTER / 2**level
    u, v = (F.tan((k + 0.5) * edge - _QUARTER / 2) for k in (i, j))
    norm = F.sqrt(1 + u * u + v * v)
    dot = F.coalesce(*[F.when(face == f, n + a * u + b * v) for f, (n, a, b) in ((f, _on_face(f, q)) for f in range(6))]) / norm
    return F.acos(F.greatest(F.least(dot, F.lit(1.0)), F.lit(-1.0))) - edge


def nearest_facility(places: DataFrame, facilities: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Nearest facility of every place by great-circle distance: ``(id, facility, km)``, ties by facility id.

    Inputs have ``(id, lat, lon)`` in degrees, ids integer; rows without a position are left out, and without facilities nobody is answered. Places at one position
    are searched for once, and of facilities at one position only the smallest id matters.
    """
    spark = places.sparkSession
    checkpoint_root(spark)
    known = lambda d: d.filter("lat is not null and lon is not null and not isnan(lat) and not isnan(lon)").withColumns({"lat": F.col("lat") + F.lit(0.0), "lon": F.col("lon") + F.lit(0.0)})
    places, facilities = known(places), known(facilities).filter("id is not null")
    f = facilities.groupBy("lat", "lon").agg(F.min("id").alias("fid"))
    spots = places.select("lat", "lon").distinct()
    both = spots.withColumn("fid", F.lit(None).cast("long")).unionByName(f.select("lat", "lon", F.col("fid").cast("long").alias("fid")))
    both = both.withColumns(unit(F.col("lat"), F.col("lon")))
    both = both.withColumns(home((F.col("x0"), F.col("x1"), F.col("x2"))))
    along = both.withColumn("z", F.shiftleft(F.col("face").cast("long"), 2 * DEEPEST) + _interleave(cell(F.col("u"), DEEPEST), cell(F.col("v"), DEEPEST)))
    here = F.when(F.col("fid").isNotNull(), F.struct("lat", "lon"))
    met = running(along.withColumn("kind", F.coalesce("fid", F.lit(-1))), [], ["z", "lat", "lon", "kind"], {"a": ("last", here), "b": ("next", here)}).checkpoint()
    angle = lambda lat, lon: haversine(F.col("lat"), F.col("lon"), lat, lon) / EARTH_KM
    radius = F.least(angle(F.col("a.lat"), F.col("a.lon")), angle(F.col("b.lat"), F.col("b.lon")))
    queries = met.filter("fid is null").select("lat", "lon", "x0", "x1", "x2", (radius * _SLACK + 1e-9).alias("radius")).filter("radius is not null")
    level = F.floor(F.log2(F.lit(_QUARTER) / (2 * F.col("radius"))))
    queries = queries.withColumn("level", (STEP * F.floor(F.greatest(F.least(level, F.lit(DEEPEST)), F.lit(0)) / STEP)).cast("int"))
    at = tuple(F.col(c) for c in ("x0", "x1", "x2"))
    held = met.filter("fid is not null").select("fid", F.col("lat").alias("flat"), F.col("lon").alias("flon"), "face", "u", "v")

    looks = queries.withColumn("c", F.explode(covering(at, F.col("radius"), F.col("level")))).select("lat", "lon", "x0", "x1", "x2", "radius", "level", "c.*").checkpoint()
    levels = sorted(r["level"] for r in looks.select("level").distinct().collect())  # at most DEEPEST / STEP + 1 values
    found, deeper = [], None
    d = haversine(F.col("lat"), F.col("lon"), F.col("flat"), F.col("flon"))
    for depth in range(levels[0] if levels else DEEPEST + STEP, DEEPEST + 1, STEP):
        mine = looks.filter(F.col("level") == depth).drop("level")
        if deeper is not None:
            mine = mine.unionByName(deeper)
        elif depth not in levels:
            continue
        cells = held.withColumns({"i": cell(F.col("u"), depth), "j": cell(F.col("v"), depth)})
        crowds = cells.groupBy("face", "i", "j").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("flat", "flon"), "fid").alias("one"))
        mine = mine.join(crowds, ["face", "i", "j"])
        if depth + STEP <= DEEPEST:
            small = mine.filter(F.col("n") <= crowd).select("face", "i", "j", "lat", "lon")
            large = mine.filter(F.col("n") > crowd)
            # a facility of a crowded cell may be nearer than the bound
            nearer = large.groupBy("lat", "lon").agg(F.min(haversine(F.col("lat"), F.col("lon"), F.col("one.flat"), F.col("one.flon")) / EARTH_KM * _SLACK + 1e-9).alias("r"))
            parts = F.sequence(F.lit(0), F.lit((1 << STEP) - 1))
            child = large.drop("n", "one").join(nearer, ["lat", "lon"]).withColumn("radius", F.least("radius", "r")).drop("r")
            child = child.withColumn("p", F.explode(parts)).withColumn("q", F.explode(parts)).select("lat", "lon", "x0", "x1", "x2", "radius", "face", ((1 << STEP) * F.col("i") + F.col("p")).alias("i"), ((1 << STEP) * F.col("j") + F.col("q")).alias("j"))
            deeper = child.filter(_least_angle(at, F.col("face"), F.col("i"), F.col("j"), depth + STEP) <= F.col("radius")).checkpoint()
            deeper = None if deeper.isEmpty() else deeper
        else:
            small, deeper = mine.select("face", "i", "j", "lat", "lon"), None
        near = small.join(cells.select("face", "i", "j", "fid", "flat", "flon"), ["face", "i", "j"])
        found.append(near.groupBy("lat", "lon").agg(F.min(F.struct(d.alias("km"), "fid")).alias("m")))
    if not found:
        return places.select("id", F.lit(None).cast("long").alias("facility"), F.lit(None).cast("double").alias("km")).limit(0)
    best = found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    best = best.groupBy("lat", "lon").agg(F.min("m").alias("m")).select("lat", "lon", F.col("m.fid").alias("facility"), F.col("m.km").alias("km"))
    return places.join(best, ["lat", "lon"]).select("id", "facility", "km")
