"""Point in polygon: the covering against the even-odd rule over all edges."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from civiclake.functions import cover
from civiclake.operators import places

RING = "array<array<struct<x: double, y: double>>>"


def circle(x, y, r, n, wobble=0.0, seed=0):
    rnd = random.Random(seed)
    return [(x + r * (1 + wobble * rnd.uniform(-1, 1)) * math.cos(2 * math.pi * k / n), y + r * (1 + wobble * rnd.uniform(-1, 1)) * math.sin(2 * math.pi * k / n)) for k in range(n)]


def holds(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < x1 + (x2 - x1) * (y - y1) / (y2 - y1):
                odd = not odd
    return odd


def frame(spark, polygons):
    rows = [(a, p, n, [[{"x": x, "y": y} for x, y in ring] for ring in rings]) for a, p, n, rings in polygons]
    return spark.createDataFrame(rows, f"layer string, place int, name string, rings {RING}")


def test_cells_of_a_polygon():
    """Each point is in a whole cell or in an edge cell whose edges tell its side, at all levels."""
    rnd = random.Random(3)
    rings = [circle(3, 4, 50, 700, 0.2, 1), circle(0, 0, 9, 30), circle(20, 10, 5, 3)]
    edges = cover.edges_of([[{"x": x, "y": y} for x, y in r] for r in rings])
    cells = {c[:3]: c for c in cover.cover(edges, 10.0, 16, 3)}
    assert len({c[0] for c in cells.values()}) > 1 and max(len(c[4]) for c in cells.values() if c[0] < 3) <= 16
    for _ in range(2000):
        x, y = rnd.uniform(-70, 70), rnd.uniform(-70, 70)
        hit = [cells[k] for lv in range(-3, 4) if (k := (lv, math.floor(x / (10.0 / 8.0**lv)), math.floor(y / (10.0 / 8.0**lv)))) in cells]
        assert len(hit) <= 1
        want = holds(rings, x, y)
        if not hit:
            assert not want
        elif not len(hit[0][4]):
            assert want == hit[0][3]


def test_one_country_and_thousands_of_small_places(spark):
    rnd = random.Random(5)
    country = ("state", 1, "country", [circle(0, 0, 1000, 4000, 0.01, 2), circle(100, 100, 30, 50)])
    small = [("town", k, f"t{k}", [circle(rnd.uniform(-900, 900), rnd.uniform(-900, 900), rnd.uniform(0.5, 4), 6, seed=k)]) for k in range(1500)]
    crowd = [("town", 5000 + k, f"c{k}", [circle(300 + k / 100, 300, 2, 12, seed=k)]) for k in range(120)]
    polygons = [country, ("state", 2, "never first", [circle(0, 0, 990, 8)]), *small, *crowd]
    points = [(k, rnd.uniform(-1100, 1100), rnd.uniform(-1100, 1100)) for k in range(400)] + [(1000 + k, p[3][0][0][0] - 0.01, p[3][0][0][1]) for k, p in enumerate([*small[:300], *crowd])] + [(5000, None, 1.0), (5001, 300.0, 300.0)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    got = {r.id: (r.state, r.town) for r in places.locate(df, frame(spark, polygons), ["state", "town"], 10.0).collect()}
    assert len(got) == len(points)
    for id_, x, y in points:
        for k, layer in enumerate(("state", "town")):
            want = None if x is None else next((n for a, _, n, rings in polygons if a == layer and holds(rings, x, y)), None)
            assert got[id_][k] == want, (id_, layer)
    grid = places.covering(frame(spark, polygons), 10.0)
    edged = grid.select("level", F.explode("edged").alias("p")).select("level", F.col("p.name").alias("name"), F.size("p.edges").alias("n"))
    assert edged.where(f"level < {places.FINEST}").agg(F.max("n")).first()[0] <= places.EDGES
    assert grid.agg(F.max(F.size("inner"))).first()[0] <= 2 and grid.where("level < 0").count() < 400
    assert len({r.level for r in grid.select("level").distinct().collect()}) <= 8


def test_points_on_borders_and_odd_polygons(spark):
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    polygons = [("a", 1, "square", [square]), ("a", 2, "none", [[]]), ("a", 3, "line", [[(20.0, 0.0), (30.0, 0.0)]]), ("b", 1, "other", [square[::-1], [(2.0, 2.0), (4.0, 2.0), (4.0, 4.0), (2.0, 4.0)]])]
    points = [(i * 8 + j, float(i), float(j)) for i in range(-1, 12) for j in range(-1, 12)]
    got = places.locate(spark.createDataFrame(points, "id long, x double, y double"), frame(spark, polygons), ["a", "b", "c"], 10.0).collect()
    for r in got:
        assert r.a == ("square" if holds([square], r.x, r.y) else None) and r.b == ("other" if holds(polygons[3][3], r.x, r.y) else None) and r.c is None
    assert np.isclose(cover.start_level(cover.edges_of([[{"x": 0, "y": 0}, {"x": 1, "y": 0}]]), 10.0, 4), 1)


def test_equal_points_are_located_once(spark):
    square = [("state", 1, "A", [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]])]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate([(1.0, 1.0), (9.0, 9.0), (None, 1.0), (-0.0, 2.0)] * 50)], "id long, x double, y double")
    out = places.locate(df, frame(spark, square), ["state"], 10.0)
    assert [r.state for r in out.orderBy("id").collect()][:3] == ["A", None, None] and out.count() == 200
    # What a point's cell tells is stored: no row of the result looks through a polygon's edges again.
    assert "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
