"""Spatial joins: point -> time-zone box, and event -> posts within a radius.

Both are non-equi predicates. Each is turned into an equi-join on a grid
cell key (so it hash-partitions and skew-splits like any other join) plus
the exact predicate as a residual filter. No cross join, no nested loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import geo as G
from hazardlake.operators.common import checkpoint, spread


def zone_cells(zones: DataFrame, cell_deg: float) -> DataFrame:
    """Explode each zone box into the grid cells it touches."""
    def rng(lo, hi):
        return F.sequence(G.cell(F.col(lo), cell_deg), G.cell(F.col(hi), cell_deg))
    # A box with lon_min > lon_max lies over the antimeridian: two parts, one area.
    over = F.col("lon_min") > F.col("lon_max")
    width = F.col("lon_max") - F.col("lon_min") + F.when(over, F.lit(360.0)).otherwise(F.lit(0.0))
    part = F.when(over, F.array(F.struct(F.col("lon_min").alias("a"), F.lit(180.0).alias("b")),
                                F.struct(F.lit(-180.0).alias("a"), F.col("lon_max").alias("b")))).otherwise(
        F.array(F.struct(F.col("lon_min").alias("a"), F.col("lon_max").alias("b"))))
    return (zones
            .withColumn("_area", (F.col("lat_max") - F.col("lat_min")) * width)
            .withColumn("_part", F.explode(part))
            .withColumn("lon_min", F.col("_part.a")).withColumn("lon_max", F.col("_part.b")).drop("_part")
            .withColumn("_clat", F.explode(rng("lat_min", "lat_max")))
            .withColumn("_clon", F.explode(rng("lon_min", "lon_max"))))


def assign_zone(points: DataFrame, zones: DataFrame, key: str, lat: str = "latitude",
                lon: str = "longitude", zone_col: str = "tz", cell_deg: float = 10.0,
                nautical: bool = False) -> DataFrame:
    """Add ``zone_col``: the smallest zone box holding each point. Without a
    box it is null, or with ``nautical`` the 15-degree zone of the longitude.

    ``zones`` has (zone, lat_min, lat_max, lon_min, lon_max); boxes may
    overlap, ties go to the smaller box, then the zone name. The zone boxes
    become one row per grid cell holding the array of boxes touching it, so
    each point meets exactly one row (its cell): the choice is an array
    expression on the point's row, without re-grouping the points; the
    planner broadcasts the cell table while it is below its threshold.
    ``key`` is kept for API symmetry; points keep all their columns.
    """
    box = F.struct(F.col("_area").alias("area"), F.col("zone").alias("zone"),
                   F.col("lat_min").alias("la0"), F.col("lat_max").alias("la1"),
                   F.col("lon_min").alias("lo0"), F.col("lon_max").alias("lo1"))
    cells = zone_cells(zones, cell_deg).groupBy("_clat", "_clon").agg(F.collect_list(box).alias("_boxes"))
    p = (points.withColumn("_clat", G.cell(F.col(lat), cell_deg))
         .withColumn("_clon", G.cell(F.col(lon), cell_deg)))
    la, lo = F.col(lat), F.col(lon)
    inside = F.filter("_boxes", lambda b: (la >= b["la0"]) & (la <= b["la1"])
                      & (lo >= b["lo0"]) & (lo <= b["lo1"]))
    best = F.array_min(F.transform(inside, lambda b: F.struct(b["area"].alias("a"), b["zone"].alias("z"))))
    zone = F.coalesce(best["z"], G.nautical_zone(lo)) if nautical else best["z"]
    return (p.join(cells, ["_clat", "_clon"], "left")
            .withColumn(zone_col, zone)
            .drop("_clat", "_clon", "_boxes"))


#: Events and posts of one cell that meet in one block, pairs per task, and room for rounding in the bound on pairs.
BLOCK_EVENTS, BLOCK_POSTS, TASK_PAIRS, DOT_SLACK = 2000, 2000, 40_000_000, 1e-9


def _slices(n: Column, size: int) -> Column:
    return F.ceil(n / F.lit(size)).cast("int")


def _vector(prefix: str, lat: Column, lon: Column) -> list[Column]:
    """The point as a unit vector."""
    la, lo = F.radians(lat), F.radians(lon)
    return [(F.cos(la) * F.cos(lo)).alias(f"{prefix}x"), (F.cos(la) * F.sin(lo)).alias(f"{prefix}y"),
            F.sin(la).alias(f"{prefix}z")]


def within_radius(events: DataFrame, posts: DataFrame, radius_km: float,
                  event_key: str, post_key: str, lat: str = "latitude",
                  lon: str = "longitude", block_events: int = BLOCK_EVENTS, block_posts: int = BLOCK_POSTS,
                  task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(event_key, post_key, dist_km) for every post within ``radius_km``.

    Cells are ``radius`` degrees of latitude tall and at least as wide, a whole
    number of them around the globe; each event lists the cells its radius
    can reach (wider in longitude toward the poles, all longitudes near a
    pole, wrapping at the antimeridian), each post sits in one cell. The
    haversine distance is the residual predicate; it is asked only where the unit vectors of
    both points leave it open.

    The pairs of a cell grow with both sides, so a cell is cut into blocks of about
    ``block_events`` x ``block_posts`` pairs, and the blocks are dealt over as many tasks as their
    pairs need (``task_pairs`` each): a task's work does not grow with the tables.
    """
    cd = radius_km / G.KM_PER_DEG_LAT
    n_lon = max(1, int(math.floor(360.0 / cd)))
    wide = 360.0 / n_lon
    eps = 1e-9      # a post on a cell border may round to either side
    la, lo = F.col(lat), F.col(lon)
    reach = F.greatest(F.abs(la - cd), F.abs(la + cd))
    dlon = F.when(reach >= 89.999, F.lit(360.0)).otherwise(
        F.lit(cd) / F.cos(F.radians(F.least(reach, F.lit(89.999)))))
    lat_cells = F.sequence(G.cell(F.greatest(la - cd, F.lit(-90.0)), cd),
                           G.cell(F.least(la + cd, F.lit(90.0)), cd))
    lon_cells = F.when(dlon >= 180.0, F.sequence(F.lit(0), F.lit(n_lon - 1))).otherwise(
        F.array_distinct(F.transform(
            F.sequence(G.cell(lo - dlon - eps, wide), G.cell(lo + dlon + eps, wide)),
            lambda c: F.pmod(c, F.lit(n_lon)))))
    ev = (spread(events.select(F.col(event_key), la.alias("_elat"), lo.alias("_elon"),
                               lat_cells.alias("_lats"), lon_cells.alias("_lons")))
          .withColumn("_clat", F.explode("_lats"))
          .withColumn("_clon", F.explode("_lons"))
          .drop("_lats", "_lons"))
    ps = spread(posts.select(F.col(post_key), la.alias("_plat"), lo.alias("_plon"),
                             G.cell(la, cd).alias("_clat"),
                             F.pmod(G.cell(lo, wide), F.lit(n_lon)).alias("_clon")))
    cell = ["_clat", "_clon"]
    met = checkpoint(ev.groupBy(*cell).agg(F.count("*").alias("_ne")).join(
        ps.groupBy(*cell).agg(F.count("*").alias("_np")), cell))
    pairs = met.agg(F.sum(F.col("_ne") * F.col("_np"))).first()[0] or 0
    tasks = max(events.sparkSession.sparkContext.defaultParallelism, -(-pairs // task_pairs))
    met = met.select(*cell, _slices(F.col("_ne"), block_events).alias("_es"), _slices(F.col("_np"), block_posts).alias("_ps"))
    block = [*cell, "_i", "_j"]
    ev = (ev.join(met, cell).withColumn("_i", F.pmod(F.hash(event_key, "_elat", "_elon"), F.col("_es")))
          .withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_ps") - 1)))
          .select(event_key, "_elat", "_elon", *block).repartition(tasks, *block))
    ps = (ps.join(met, cell).withColumn("_j", F.pmod(F.hash(post_key, "_plat", "_plon"), F.col("_ps")))
          .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_es") - 1)))
          .select(post_key, "_plat", "_plon", *block).repartition(tasks, *block))
    ev = ev.select("*", *_vector("_e", F.col("_elat"), F.col("_elon")))
    ps = ps.select("*", *_vector("_p", F.col("_plat"), F.col("_plon")))
    d = G.haversine_km(F.col("_elat"), F.col("_elon"), F.col("_plat"), F.col("_plon"))
    dot = F.col("_ex") * F.col("_px") + F.col("_ey") * F.col("_py") + F.col("_ez") * F.col("_pz")
    # Beyond half the globe's girth every pair is near enough.
    edge = math.cos(min(radius_km / G.EARTH_RADIUS_KM, math.pi))
    near = (dot >= F.lit(edge - DOT_SLACK)) & ((dot > F.lit(edge + DOT_SLACK)) | (d <= F.lit(radius_km)))
    return ev.hint("shuffle_hash").join(ps, block).where(near).select(event_key, post_key, d.alias("dist_km"))
