"""Zones by polygon: one polygon per nation, by rule, and the DuckDB SQL that tests all edges."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.operators import polygons as P
from hazardlake.plans import catalog as C
from hazardlake.plans.oracle import lat_expr, lon_expr, nautical
from hazardlake.plans.tables import load

# A nation's zone is a star around a centre by its key, in hundredths of a degree: corner j lies in direction j (in
# hundredths) at 3 to 9 times 1 + (key * 7 + j * 5) % 3 degrees. Odd keys have a hole of a third of that size, turned round.
DIRECTIONS = [(100, 0), (87, 50), (50, 87), (0, 100), (-50, 87), (-87, 50),
              (-100, 0), (-87, -50), (-50, -87), (0, -100), (50, -87), (87, -50)]
ZONE_CELL_DEG = 2.0


def nation_rings(spark, sf):
    """(zone, ring): outer rings and holes; centres within 170 to 190 degrees east reach over the antimeridian."""
    n = load(spark, sf, "nation", "n_nationkey", "n_name")
    key = F.col("n_nationkey")
    lon, lat = (key * 29) % 360 - 175, (key * 17) % 121 - 60

    def ring(divide: int):
        points = [F.struct((lon + dx * (key % 3 + 1) * (1 + (key * 7 + j * 5) % 3) * 3 / (100.0 * divide)).alias("lon"),
                           (lat + dy * (key % 3 + 1) * (1 + (key * 7 + j * 5) % 3) * 3 / (100.0 * divide)).alias("lat"))
                  for j, (dx, dy) in enumerate(DIRECTIONS)]
        return F.array(*(points if divide == 1 else points[::-1]))

    outer = n.select("n_name", ring(1).alias("ring"))
    holes = n.where(key % 2 == 1).select("n_name", ring(3).alias("ring"))
    return outer.unionByName(holes).select(F.concat(F.lit("Zone/"), "n_name").alias("zone"), "ring")


def tz_polygon_join(spark, sf):
    """Point -> zone polygon of least area that holds it, else the 15-degree zone of its longitude."""
    points = C._customer_points(spark, sf)
    z = P.assign_polygon(points, nation_rings(spark, sf), cell_deg=ZONE_CELL_DEG, nautical=True)
    return z.select("c_custkey", "tz")


def _ring_sql(divide: int) -> str:
    points = []
    for j, (dx, dy) in enumerate(DIRECTIONS):
        r = f"(k % 3 + 1) * (1 + (k * 7 + {j * 5}) % 3) * 3 / {100.0 * divide}"
        points.append(f"{{'x': CAST(round(((k * 29) % 360 - 175 + {dx} * {r}) * {P.SCALE}) AS BIGINT), "
                      f"'y': CAST(round(((k * 17) % 121 - 60 + {dy} * {r}) * {P.SCALE}) AS BIGINT)}}")
    return "[" + ", ".join(points if divide == 1 else points[::-1]) + "]"


QUERIES = {"tz_polygon_join": tz_polygon_join}
ORACLE = {"tz_polygon_join": f"""
  WITH n AS (SELECT CAST(n_nationkey AS BIGINT) AS k, 'Zone/' || n_name AS zone FROM nation),
  r AS (SELECT zone, {_ring_sql(1)} AS ring FROM n UNION ALL SELECT zone, {_ring_sql(3)} FROM n WHERE k % 2 = 1),
  e AS (SELECT zone, unnest(list_transform(range(1, len(ring) + 1), lambda i: {{'a': ring[i], 'b': ring[i % len(ring) + 1]}})) AS e
        FROM r),
  ed AS (SELECT zone, e.a.x AS x1, e.a.y AS y1, e.b.x AS x2, e.b.y AS y2 FROM e),
  area AS (SELECT zone, abs(sum(CAST(x1 AS HUGEINT) * y2 - CAST(x2 AS HUGEINT) * y1)) AS area FROM ed GROUP BY zone),
  p AS (SELECT c_custkey, lat, lon, CAST(round(lon * {P.SCALE}) AS BIGINT) AS x, CAST(round(lat * {P.SCALE}) AS BIGINT) AS y
        FROM (SELECT c_custkey, {lat_expr('c_custkey')} AS lat, {lon_expr('c_custkey')} AS lon FROM customer)),
  hit AS (SELECT c_custkey, zone FROM p, range(-1, 2) AS s(s), ed
          WHERE (y1 <= y) <> (y2 <= y) AND CASE WHEN y2 > y1
            THEN CAST(y - y1 AS HUGEINT) * (x2 - x1) <= CAST(x + s * 360 * {P.SCALE} - x1 AS HUGEINT) * (y2 - y1)
            ELSE CAST(y - y1 AS HUGEINT) * (x2 - x1) >= CAST(x + s * 360 * {P.SCALE} - x1 AS HUGEINT) * (y2 - y1) END
          GROUP BY c_custkey, zone, s HAVING count(*) % 2 = 1)
  SELECT c_custkey, coalesce(first(zone), first({nautical('lon')})) AS tz
  FROM (SELECT p.*, zone FROM p LEFT JOIN hit USING (c_custkey) LEFT JOIN area USING (zone)
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY area, zone) = 1) GROUP BY c_custkey"""}
