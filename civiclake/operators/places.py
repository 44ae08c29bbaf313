"""Places: the property 360 join and polygon enrichment."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.sources.scratch import materialize


def _attach(left: DataFrame, right: DataFrame, name: str, on: list[str]) -> DataFrame:
    """A left join; columns of ``right`` that ``left`` has too get its name in front."""
    have = set(left.columns)
    return left.join(right.select(*on, *(F.col(c).alias(f"{name}_{c}" if c in have else c) for c in right.columns if c not in on)), on, "left")


def property_360(addresses: DataFrame, assessments: DataFrame, appraisals: DataFrame, highlights: DataFrame) -> DataFrame:
    """Every address with its assessment and appraisal (by ``ssl``) and its highlights (by ``latitude``, ``longitude``).

    The two joins on ``ssl`` share one shuffle of the addresses. Null keys match nothing; several rows of a key multiply.
    """
    out = _attach(addresses, assessments, "assessment", ["ssl"])
    out = _attach(out, appraisals, "appraisal", ["ssl"])
    return _attach(out, highlights, "highlight", ["latitude", "longitude"])


#: Edges of one polygon, and of all polygons, in a cell; with more it is split, down to the finest level.
EDGES, CROWD, FINEST = 32, 512, 4
EDGE = "struct<x1: double, y1: double, x2: double, y2: double>"
CELL = f"level int, cx long, cy long, layer string, place long, name string, odd boolean, edges array<{EDGE}>"


def _cells(rows: DataFrame, make) -> DataFrame:
    """Cells that ``make`` gives for each row, handed on in batches of bounded size."""

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.struct([(n, pa.float64()) for n in ("x1", "y1", "x2", "y2")]))]
        names = ["level", "cx", "cy", "layer", "place", "name", "odd", "edges"]
        batch = lambda held: pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], t) for k, t in enumerate(kinds)], names)
        held, size = [], 0
        for b in batches:
            for r in b.to_pylist():
                for level, cx, cy, odd, edges in make(r):
                    held.append((level, cx, cy, r["layer"], r["place"], r["name"], odd, [dict(zip(("x1", "y1", "x2", "y2"), e, strict=True)) for e in edges.tolist()]))
                    size += len(edges) + 1
                    if size > 1 << 16:
                        yield batch(held)
                        held, size = [], 0
        if held:
            yield batch(held)

    return rows.mapInArrow(run, CELL)


def covering(polygons: DataFrame, cell: float, most: int = EDGES, crowd: int = CROWD, finest: int = FINEST) -> DataFrame:
    """A row a cell of a level: inner (the first polygon of each layer that holds the whole cell) and edged (polygons whose edges touch it, those edges alone).

    A polygon begins with the few cells that it spans, however large or small they are, and its cells are split while
    they hold many of its edges (``functions.cover``); so are cells that hold many edges of several polygons, all
    together, one level a round. A cell that lies within a polygon needs no edges, and only the first such polygon of a
    layer. What the finest cells still hold stays whole. Runs jobs and stores a table a round when called.
    """
    from civiclake.functions import cover

    point = lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y"))
    flat = polygons.select(F.col("layer").cast("string").alias("layer"), F.col("place").cast("long").alias("place"), F.col("name").cast("string").alias("name"), F.transform("rings", lambda r: F.transform(r, point)).alias("rings"))
    first = _cells(flat.where("rings IS NOT NULL"), lambda r: cover.cover(cover.edges_of(r["rings"]), cell, most, finest))
    spread = lambda r: cover.split(np.array([list(e.values()) for e in r["edges"]], float).reshape(-1, 4), r["level"], r["cx"], r["cy"], r["odd"], cell)
    rows, key = materialize(first), ["level", "cx", "cy"]
    while True:
        full = rows.where(F.size("edges") > 0).groupBy(*key).agg(F.sum(F.size("edges")).alias("n"), F.count(F.lit(1)).alias("k"))
        full = materialize(full.where((F.col("n") > crowd) & (F.col("k") > 1) & (F.col("level") < finest)).select(*key))
        if full.isEmpty():
            break
        edged = F.size("edges") > 0
        rows = materialize(rows.where(~edged).unionByName(rows.where(edged).join(full, key, "left_anti").select(*rows.columns)).unionByName(_cells(rows.where(edged).join(full, key, "left_semi").select(*rows.columns), spread)))
    whole = F.size("edges") == 0
    inner = rows.where(whole).groupBy(*key, "layer").agg(F.min(F.struct("place", "name")).alias("p"))
    inner = inner.groupBy(*key).agg(F.collect_list(F.struct("layer", "p.place", "p.name")).alias("inner"))
    edged = rows.where(~whole).groupBy(*key).agg(F.collect_list(F.struct("layer", "place", "name", "odd", "edges")).alias("edged"))
    return materialize(inner.join(edged, key, "full"))


def _holds(p: Column, x: Column, y: Column, rx: Column, ry: Column) -> Column:
    """Whether a polygon of a cell holds a point of the cell: the crossings on the way from the cell's reference point, up and then across."""
    at_x = lambda e: e["x1"] + F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"])
    at_y = lambda e: e["y1"] + F.try_divide((e["y2"] - e["y1"]) * (rx - e["x1"]), e["x2"] - e["x1"])
    across = F.filter(p["edges"], lambda e: ((e["y1"] > y) != (e["y2"] > y)) & ((rx < at_x(e)) != (x < at_x(e))))
    up = F.filter(p["edges"], lambda e: ((e["x1"] > rx) != (e["x2"] > rx)) & ((at_y(e) > ry) != (at_y(e) > y)))
    return (F.size(across) + F.size(up) + p["odd"].cast("int")) % 2 == 1


def locate(points: DataFrame, polygons: DataFrame, layers: list[str], cell: float) -> DataFrame:
    """``points`` with one column a layer: the name of its first polygon that holds (x, y) by the even-odd rule, or null.

    ``polygons``: layer, place (order within the layer), name, rings array<array<struct<x, y>>> (holes are further
    rings). They are covered by cells of several levels, of width ``cell`` at level 0 (see ``covering``); points meet the
    cells of each level that occurs, a few, by an equi join and are not multiplied. A cell's row holds the edges that
    touch it and no more. Equal points are located once, which is stored, and all points meet their place again by an
    equi join, whose hot keys adaptive execution splits. Points without coordinates and repeated points stay.
    """
    from civiclake.functions.cover import FAN, SPOT_X, SPOT_Y

    grid = covering(polygons.where(F.col("layer").isin(*layers)), cell)
    levels = sorted(r[0] for r in grid.select("level").distinct().collect())
    met, x, y = points.select("x", "y").where("x IS NOT NULL AND y IS NOT NULL").distinct(), F.col("x"), F.col("y")
    found: dict[str, list[Column]] = {n: [] for n in layers}
    for k, level in enumerate(levels):
        size = F.lit(cell / float(FAN) ** level)
        one = grid.where(F.col("level") == level).select(F.col("cx").alias(f"__gx{k}"), F.col("cy").alias(f"__gy{k}"), F.col("inner").alias(f"__inner{k}"), F.col("edged").alias(f"__edged{k}"))
        met = met.withColumn(f"__cx{k}", F.floor(x / size)).withColumn(f"__cy{k}", F.floor(y / size))
        met = met.join(one, (F.col(f"__cx{k}") == F.col(f"__gx{k}")) & (F.col(f"__cy{k}") == F.col(f"__gy{k}")), "left")
        rx, ry = (F.col(f"__cx{k}") + F.lit(SPOT_X)) * size, (F.col(f"__cy{k}") + F.lit(SPOT_Y)) * size
        held = F.filter(f"__edged{k}", lambda p: _holds(p, x, y, rx, ry))  # noqa: B023
        named = lambda p: F.struct(p["place"].alias("place"), p["name"].alias("name"))
        for n in layers:
            for column in (F.col(f"__inner{k}"), held):
                found[n].append(F.array_min(F.transform(F.filter(column, lambda p: p["layer"] == n), named)))  # noqa: B023
    least = {n: F.array_min(F.array_compact(F.array(*c)))["name"] if c else F.lit(None).cast("string") for n, c in found.items()}
    spots = materialize(met.select(x.alias("__x"), y.alias("__y"), *(c.alias(n) for n, c in least.items())))
    return points.join(spots, (x == F.col("__x")) & (y == F.col("__y")), "left").select(*points.columns, *layers)
