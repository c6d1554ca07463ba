"""Point-in-polygon joins over a grid of edges.

Coordinates become integers (``scale`` units per degree, doubled, so that data are even and grid
lines odd): no vertex lies on a grid line and every test is exact. A zone is any number of rings; a
point is inside if a line from it to the west meets the zone's edges an odd number of times,
so holes and several parts need no special case. A point on an edge belongs to the east of it.

Cells that no edge touches and that lie wholly inside carry the zone alone. A border cell carries its own edges and
the parity of its south-west corner (counted once per zone and grid row from the edges that cross the row's
south line). A point's parity is the corner's, plus the edges between corner and
the point's foot on the west line, plus those between foot and point: only edges of the cell are looked at.
Rings may pass the antimeridian: their longitudes then run on beyond 180 degrees (or below -180).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import geo as G

SCALE = 1_000_000
_CELL = ["_row", "_col"]


def _units(degrees: Column, scale: int) -> Column:
    return F.round(degrees * scale).cast("long") * 2


def _ceil_div(a: str, b: str) -> Column:
    """Exact ceiling of a / b for longs, b > 0."""
    return F.expr(f"({a}) div ({b}) + CASE WHEN ({a}) % ({b}) > 0 THEN 1 ELSE 0 END")


def ring_edges(rings: DataFrame, scale: int = SCALE) -> DataFrame:
    """(zone, x1, y1, x2, y2, area) for rings (zone, ring array<struct<lon, lat>>), closed by themselves.

    Edges run upwards; ``area`` is the edge's part of the signed area of its ring (a hole runs the
    other way round than its zone). Copies shifted by 360 degrees stand in for the far side of the antimeridian.
    """
    n = F.size("ring")
    edge = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(
        F.get("ring", i).alias("a"), F.get("ring", (i + 1) % n).alias("b")))
    e = rings.where(n >= 3).select("zone", F.explode(edge).alias("e")).select(
        "zone", *[_units(F.col(f"e.{p}.{c}"), scale).alias(f"{p}_{c}") for p in "ab" for c in ("lon", "lat")])
    area = (F.col("a_lon").cast("decimal(38,0)") * F.col("b_lat") - F.col("b_lon").cast("decimal(38,0)") * F.col("a_lat"))
    up = F.col("a_lat") <= F.col("b_lat")
    pick = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    upward = e.select("zone", pick("a_lon", "b_lon").alias("x1"), pick("a_lat", "b_lat").alias("y1"),
                      pick("b_lon", "a_lon").alias("x2"), pick("b_lat", "a_lat").alias("y2"), area.alias("area"))
    turn = 360 * scale * 2
    span = upward.groupBy("zone").agg(F.min(F.least("x1", "x2")).alias("lo"), F.max(F.greatest("x1", "x2")).alias("hi"))
    half = 180 * scale * 2
    shifts = F.filter(F.array(*[F.lit(k * turn) for k in (-1, 0, 1)]),
                      lambda s: (F.col("lo") + s < half) & (F.col("hi") + s >= -half))
    return (upward.join(span.select("zone", shifts.alias("shifts")), "zone")
            .select("zone", F.explode("shifts").alias("s"), "x1", "y1", "x2", "y2", "area")
            .select("zone", *[(F.col(c) + F.col("s")).alias(c) if c[0] == "x" else F.col(c) for c in ("x1", "y1", "x2", "y2")],
                    F.when(F.col("s") == 0, F.col("area")).otherwise(0).alias("area")))


def _edge_cells(edges: DataFrame, size: int, last: int) -> DataFrame:
    """Each edge in the cells that it can touch: per grid row the columns of its part inside the row."""
    rows = edges.withColumn("_row", F.explode(F.sequence(F.expr(f"floor((y1 + 1) / {size}D)"),
                                                         F.expr(f"floor((y2 + 1) / {size}D)"))))
    at = lambda y: (f"x1 + (least(greatest({y}, y1), y2) - y1) * CAST(x2 - x1 AS DOUBLE) / (y2 - y1)")
    low, high = at(f"_row * {size} - 1"), at(f"(_row + 1) * {size} - 1")
    flat = "y1 = y2"
    west = F.expr(f"CASE WHEN {flat} THEN least(x1, x2) ELSE least({low}, {high}) - 2 END")
    east = F.expr(f"CASE WHEN {flat} THEN greatest(x1, x2) ELSE greatest({low}, {high}) + 2 END")
    first, stop = F.floor((west + 1) / F.lit(float(size))), F.floor((east + 1) / F.lit(float(size)))
    inside = rows.where((first <= last) & (stop >= -last - 1))
    return inside.withColumn("_col", F.explode(F.sequence(F.greatest(first, F.lit(-last - 1).cast("long")),
                                                          F.least(stop, F.lit(last).cast("long")))))


def zone_grid(rings: DataFrame, cell_deg: float = 1.0, scale: int = SCALE) -> DataFrame:
    """(_row, _col, _zones): per grid cell the zones that touch or hold it, each with corner parity and edges."""
    size, last = int(round(cell_deg * scale)) * 2, int(180 / cell_deg) - 1
    edges = ring_edges(rings, scale)
    areas = edges.groupBy("zone").agg(F.abs(F.sum("area")).alias("area"))
    touched = _edge_cells(edges, size, last).select(
        "zone", *_CELL, F.struct("x1", "y1", "x2", "y2").alias("edge"), F.lit(False).alias("odd"))
    # South lines that an edge crosses, and the first column whose corner lies east of the crossing.
    lines = edges.where("y1 < y2").withColumn("_row", F.explode(F.expr(
        f"CASE WHEN floor((y2 + 1) / {size}D) > floor((y1 + 1) / {size}D) THEN "
        f"sequence(floor((y1 + 1) / {size}D) + 1, floor((y2 + 1) / {size}D)) ELSE array() END")))
    k = _ceil_div(f"(x1 + 1) * (y2 - y1) + (_row * {size} - 1 - y1) * (x2 - x1)", f"(y2 - y1) * {size}")
    met = (lines.select("zone", "_row", F.greatest(k, F.lit(-last - 1).cast("long")).alias("k"))
           .groupBy("zone", "_row").agg(F.array_sort(F.collect_list("k")).alias("k")))
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size("k") / 2).cast("int") - 1), lambda i: F.struct(
        F.get("k", 2 * i).alias("a"), F.least(F.get("k", 2 * i + 1) - 1, F.lit(last).cast("long")).alias("z")))
    odd = (met.select("zone", "_row", F.explode(F.filter(spans, lambda s: s["a"] <= s["z"])).alias("s"))
           .select("zone", "_row", F.explode(F.sequence("s.a", "s.z")).alias("_col"), F.lit(True).alias("odd")))
    cells = (touched.unionByName(odd, allowMissingColumns=True).groupBy("zone", *_CELL)
             .agg(F.max("odd").alias("odd"), F.collect_list("edge").alias("edges")).join(areas, "zone"))
    return cells.groupBy(*_CELL).agg(F.collect_list(F.struct("area", "zone", "odd", "edges")).alias("_zones"))


def _inside(zone: Column, x: Column, y: Column, west: Column, south: Column) -> Column:
    """Parity of a point from the corner's and the cell's edges."""
    def below(e, px, py):
        # An edge that passes exactly through the foot lies below it if it falls to the east or is level.
        rise = F.when(e["x1"] <= e["x2"], e["y2"] - e["y1"]).otherwise(e["y1"] - e["y2"])
        width = F.abs(e["x2"] - e["x1"])
        left_x, left_y = F.least(e["x1"], e["x2"]), F.when(e["x1"] <= e["x2"], e["y1"]).otherwise(e["y2"])
        turn = width * (py - left_y) - rise * (px - left_x)
        return (turn > 0) | ((turn == 0) & (rise <= 0))

    def crossed(e):
        dy = e["y2"] - e["y1"]
        reach = (y - e["y1"]) * (e["x2"] - e["x1"])
        across = ((e["y1"] <= y) & (y < e["y2"]) & (reach <= (x - e["x1"]) * dy) & (reach > (west - e["x1"]) * dy))
        upright = ((e["x1"] < west) != (e["x2"] < west)) & (below(e, west, y) != below(e, west, south))
        return across != upright

    met = F.size(F.filter(zone["edges"], crossed))
    return (met + zone["odd"].cast("int")) % 2 == 1


def assign_polygon(points: DataFrame, rings: DataFrame, lat: str = "latitude", lon: str = "longitude",
                   zone_col: str = "tz", cell_deg: float = 1.0, scale: int = SCALE, nautical: bool = False) -> DataFrame:
    """Add ``zone_col``: the zone of least area that holds each point (ties by name); without one null,
    or with ``nautical`` the 15-degree zone of the longitude. Points keep their columns; null coordinates have no zone.
    """
    size = int(round(cell_deg * scale)) * 2
    east = (F.col(lon) + 180.0) - F.floor((F.col(lon) + 180.0) / 360.0) * 360.0 - 180.0
    placed = points.withColumn("_x", _units(east, scale)).withColumn("_y", _units(F.col(lat), scale))
    placed = placed.withColumn("_x", F.when(F.col("_x") >= 360 * scale, F.col("_x") - 720 * scale).otherwise(F.col("_x")))
    placed = (placed.withColumn("_row", F.floor((F.col("_y") + 1) / F.lit(float(size))))
              .withColumn("_col", F.floor((F.col("_x") + 1) / F.lit(float(size)))))
    west, south = F.col("_col") * size - 1, F.col("_row") * size - 1
    held = F.filter("_zones", lambda z: _inside(z, F.col("_x"), F.col("_y"), west, south))
    best = F.array_min(F.transform(held, lambda z: F.struct(z["area"].alias("a"), z["zone"].alias("z"))))["z"]
    zone = F.coalesce(best, G.nautical_zone(F.col(lon))) if nautical else best
    return (placed.join(zone_grid(rings, cell_deg, scale), _CELL, "left")
            .withColumn(zone_col, zone).drop("_x", "_y", "_zones", *_CELL))
