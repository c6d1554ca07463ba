"""Polygon zones against a plain crossing count in exact integers."""

import random

import pytest
from pyspark.sql import functions as F

from hazardlake.operators import polygons as P

RINGS = "zone string, ring array<struct<lon:double,lat:double>>"


def plain_zones(rings, points):
    """Smallest-area zone per point by testing all edges; coordinates are whole numbers."""
    edges, area = {}, {}
    for zone, ring in rings:
        if len(ring) < 3:
            continue
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            edges.setdefault(zone, []).append((x1, y1, x2, y2))
            area[zone] = area.get(zone, 0) + x1 * y2 - x2 * y1

    def holds(zone, x, y):
        odd = 0
        for s in (-360, 0, 360):
            for x1, y1, x2, y2 in edges[zone]:
                if (y1 <= y) != (y2 <= y):
                    if y1 > y2:
                        x1, y1, x2, y2 = x2, y2, x1, y1
                    odd ^= (y - y1) * (x2 - x1) <= (x + s - x1) * (y2 - y1)
        return odd

    out = {}
    for i, x, y in points:
        found = [] if x is None or y is None else [(abs(area[z]), z) for z in edges if holds(z, (x + 180) % 360 - 180, y)]
        out[i] = min(found)[1] if found else None
    return out


def run(spark, rings, points, cell):
    r = spark.createDataFrame([(z, [(float(x), float(y)) for x, y in ring]) for z, ring in rings], RINGS)
    p = spark.createDataFrame([(i, None if x is None else float(x), None if y is None else float(y), "k") for i, x, y in points],
                              "id long, longitude double, latitude double, zone string")
    out = P.assign_polygon(p, r, cell_deg=cell, scale=1)
    assert out.columns == [*p.columns, "tz"]
    return {r.id: r.tz for r in out.collect()}


@pytest.mark.parametrize("cell,seed", [(2.0, 1), (5.0, 2), (30.0, 3), (180.0, 4)])
def test_whole_number_polygons(spark, cell, seed):
    """Vertices, edges and points share coordinates, so every kind of tie occurs."""
    rng = random.Random(seed)
    rings = [("square", [(0, 0), (10, 0), (10, 10), (0, 10)]), ("square", [(3, 3), (3, 6), (6, 6), (6, 3)]),
             ("far", [(170, -20), (195, -25), (190, 5), (172, 0)]), ("far", [(178, -12), (178, -8), (184, -8), (184, -12)]),
             ("west", [(-190, 30), (-170, 30), (-170, 50), (-190, 50)]), ("thin", [(20, 1), (60, 3), (20, 2)]),
             ("parts", [(-100, -10), (-90, -10), (-95, 0)]), ("parts", [(-80, -10), (-70, -10), (-75, 0)]),
             ("line", [(5, 5), (9, 9)]), ("belt", [(-180, 60), (180, 60), (180, 63), (-180, 63)])]
    for k in range(6):
        cx, cy = rng.randint(-150, 150), rng.randint(-60, 60)
        rings.append((f"star{k}", [(cx + dx * rng.randint(2, 9), cy + dy * rng.randint(2, 9)) for dx, dy in
                                   ((1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1))]))
    spots = [(rng.randint(-180, 180), rng.randint(-90, 90)) for _ in range(1500)]
    for _, ring in rings:
        spots += ring + [(x + dx, y + dy) for x, y in ring for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    spots += [(x, y) for x in range(-1, 12) for y in range(-1, 12)] + [(180, 40), (-180, 40), (540, 40), (None, 4), (4, None)]
    points = [(i, x, y) for i, (x, y) in enumerate(spots)]
    assert run(spark, rings, points, cell) == plain_zones(rings, points)


def test_inner_cells_carry_no_edges(spark):
    r = spark.createDataFrame([("big", [(0.5, 0.5), (50.5, 0.5), (50.5, 50.5), (0.5, 50.5)])], RINGS)
    grid = P.zone_grid(r, cell_deg=5.0).select("_row", "_col", F.size(F.col("_zones")[0]["edges"]).alias("n")).collect()
    inner = {(r._row, r._col) for r in grid if r.n == 0}
    assert inner == {(a, b) for a in range(1, 10) for b in range(1, 10)}
    assert len(grid) <= 11 * 11 and max(r.n for r in grid) == 2


def test_no_zones_and_no_points(spark):
    none = spark.createDataFrame([], RINGS)
    p = spark.createDataFrame([(1, 10.0, 5.0)], "id long, longitude double, latitude double")
    assert [r.tz for r in P.assign_polygon(p, none).collect()] == [None]
    assert [r.tz for r in P.assign_polygon(p, none, nautical=True).collect()] == ["Etc/GMT-1"]
    assert P.assign_polygon(p.limit(0), none).collect() == []
