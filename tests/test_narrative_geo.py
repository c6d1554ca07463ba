import math

from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.operators import geo as GO
from hazardlake.operators import narrate as N


def test_place_parse_single_of_and_unparsable(spark):
    df = spark.createDataFrame([("31 km NNE of Sœurbec, Westmark",), ("Bay of Larks, Ostland",), ("0 km SSE of Q, Ostland",),
                                ("99999999999 km N of Far, Ostland",)], "place string")
    got = {r.place: (r.s, r.c) for r in df.select(
        "place", N.place_sentence(F.col("place")).alias("s"), T.country_of(F.col("place")).alias("c")).collect()}
    assert got["31 km NNE of Sœurbec, Westmark"] == ("31 km North-Northeast of Sœurbec, Westmark", "Westmark")
    assert got["Bay of Larks, Ostland"] == ("Bay of Larks, Ostland", "Ostland")
    assert got["0 km SSE of Q, Ostland"][0] == "0 km South-Southeast of Q, Ostland"
    # A distance beyond an int does not end the job: the place stays as it is.
    assert got["99999999999 km N of Far, Ostland"][0] == "99999999999 km N of Far, Ostland"


def test_narrative_local_time_padding_and_hemispheres(spark):
    df = spark.createDataFrame(
        [(1, "2030-03-05 21:04:59", 4.6, 6.5, "7 km SW of Alderbrook, Westmark", 44.5, 11.25, "Asia/Tokyo"),
         (2, "2030-12-31 06:09:00", 6.1, 31.0, "Bay of Larks, Ostland", 0.0, -9.75, None),
         (3, "2030-12-31 06:09:00", 1e9, 31.0, "X", 0.0, -9.75, None)],
        "event_id int, t string, magnitude double, depth double, place string, latitude double, longitude double, tz string"
    ).withColumn("rupture_time", F.col("t").cast("timestamp_ntz"))
    got = {r.event_id: r.narrative for r in N.event_narratives(df).collect()}
    assert got[1] == ("On March 6, 2030, at approximately 06:04 local time, a magnitude 4.6 earthquake, "
                      "with a depth of 6.50 km, struck 7 km Southwest of Alderbrook, Westmark. The coordinate of "
                      "epicenter of the earthquake was 44.5000°N, 11.2500°E.")
    # Zone missing -> told in UTC, and named so; minute zero-padded; latitude 0 reads as S; unparsable place kept.
    assert got[2].startswith("On December 31, 2030, at approximately 06:09 UTC, a magnitude")
    assert "struck Bay of Larks, Ostland." in got[2] and "0.0000°S, 9.7500°W" in got[2]
    assert got[3] is None       # a magnitude that fits no number format


def test_assign_zone_smallest_box_wins(spark):
    pts = spark.createDataFrame([(1, 30.0, 75.0), (2, 30.0, 100.0), (3, -80.0, 0.0)],
                                "id int, latitude double, longitude double")
    zones = spark.createDataFrame([("Big", 0.0, 60.0, 60.0, 140.0), ("Small", 25.0, 35.0, 70.0, 80.0)],
                                  "zone string, lat_min double, lat_max double, lon_min double, lon_max double")
    got = {r.id: r.tz for r in GO.assign_zone(pts, zones, "id", cell_deg=7.0).collect()}
    assert got == {1: "Small", 2: "Big", 3: None}


def _hav(a, b, c, d):
    p1, p2 = math.radians(a), math.radians(c)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * 6371.0088 * math.asin(min(1.0, math.sqrt(h)))


def test_within_radius_matches_brute_force_incl_pole_and_antimeridian(spark):
    ev = [(1, 0.0, 179.9), (2, 89.5, 10.0), (3, -45.0, -120.0), (4, 60.0, 0.0)]
    import random
    rnd = random.Random(7)
    ps = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(3000)]
    ps += [(9001, 0.0, -179.9), (9002, 88.0, -170.0), (9003, -44.0, -121.0)]
    e = spark.createDataFrame(ev, "eid int, latitude double, longitude double")
    p = spark.createDataFrame(ps, "pid int, latitude double, longitude double")
    r = 400.0
    got = sorted((x.eid, x.pid) for x in GO.within_radius(e, p, r, "eid", "pid").collect())
    want = sorted((a, b) for a, la, lo in ev for b, pla, plo in ps if _hav(la, lo, pla, plo) <= r)
    assert got == want and (1, 9001) in got and (2, 9002) in got


def test_zone_over_the_antimeridian_and_nautical_zones(spark):
    pts = spark.createDataFrame([(1, -17.0, 178.0), (2, -17.0, -179.5), (3, -17.0, 170.0), (4, 10.0, -100.0), (5, 0.0, 3.0)],
                                "id int, latitude double, longitude double")
    zones = spark.createDataFrame([("Seam", -21.0, -12.0, 176.0, -178.0)],
                                  "zone string, lat_min double, lat_max double, lon_min double, lon_max double")
    got = {r.id: r.tz for r in GO.assign_zone(pts, zones, "id").collect()}
    assert got == {1: "Seam", 2: "Seam", 3: None, 4: None, 5: None}
    sea = {r.id: r.tz for r in GO.assign_zone(pts, zones, "id", nautical=True).collect()}
    assert sea == {1: "Seam", 2: "Seam", 3: "Etc/GMT-11", 4: "Etc/GMT+7", 5: "Etc/GMT"}


def test_radius_at_the_seam_at_random_offsets(spark):
    import random
    rnd = random.Random(11)
    ev = [(i, rnd.uniform(-70, 70), rnd.choice([-1, 1]) * rnd.uniform(170, 180)) for i in range(40)]
    ps = [(i, rnd.uniform(-75, 75), rnd.choice([-1, 1]) * rnd.uniform(168, 180)) for i in range(1500)]
    ps += [(9000, 0.0, 180.0), (9001, 0.0, -180.0)]
    e = spark.createDataFrame(ev, "eid int, latitude double, longitude double")
    p = spark.createDataFrame(ps, "pid int, latitude double, longitude double")
    for r in (137.0, 500.0, 1900.0):
        got = sorted((x.eid, x.pid) for x in GO.within_radius(e, p, r, "eid", "pid").collect())
        assert got == sorted((a, b) for a, la, lo in ev for b, pla, plo in ps if _hav(la, lo, pla, plo) <= r)


def test_a_crowded_cell_is_dealt_over_many_tasks(spark):
    """All points in one cell, some keys repeated or null: every pair once, no task with most of them."""
    import random
    from pyspark.sql import functions as F
    rnd = random.Random(5)
    ev = [(i % 190 or None, 10 + rnd.random(), 20 + rnd.random()) for i in range(200)] + [(900, None, 20.0)]
    ps = [(i % 380 or None, 10 + rnd.random(), 20 + rnd.random()) for i in range(400)] + [(901, 10.0, None)]
    e = spark.createDataFrame(ev, "eid int, latitude double, longitude double").coalesce(1)
    p = spark.createDataFrame(ps, "pid int, latitude double, longitude double").coalesce(1)
    sizes = {"block_events": 20, "block_posts": 20, "task_pairs": 2000}
    got = GO.within_radius(e, p, 60.0, "eid", "pid", **sizes)
    got = got.withColumn("task", F.spark_partition_id()).collect()
    want = [(a, b) for a, la, lo in ev[:-1] for b, pla, plo in ps[:-1] if _hav(la, lo, pla, plo) <= 60.0]
    key = lambda t: (t[0] or -1, t[1] or -1)
    assert sorted(((x.eid, x.pid) for x in got), key=key) == sorted(want, key=key)
    share = [sum(x.task == t for x in got) for t in {x.task for x in got}]
    assert len(share) > 20 and max(share) < len(want) / 8
