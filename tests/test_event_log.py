import json
import os
import tempfile

from pyspark.sql import functions as F

from hazardlake.operators import dedupe as D
from hazardlake.operators import retention as R
from hazardlake.sources import feed as FD


def _feature(place, mag, ms, alert, url, coords):
    return {"properties": {"place": place, "mag": mag, "time": ms, "felt": 3, "cdi": 4.1,
                           "mmi": 5.2, "alert": alert, "url": url},
            "geometry": {"coordinates": coords}}


def test_read_and_flatten_feed(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    doc = {"type": "FeatureCollection", "features": [
        _feature("7 km WSW of Alderbrook, Westmark", 4.6, 1700000000000, "yellow", "https://x/ev/q1", [11.25, 44.5, 6.5]),
        _feature("Bay of Larks, Ostland", 6.1, 1700003600000, "red", "https://x/ev/q2/", [150.125, -9.75, 31.0]),
        _feature("Nowhere", 2.0, 1700003600000, "green", "https://x/ev/q3", [1.0, 2.0, 3.0]),
    ]}
    with open(os.path.join(d, "f.json"), "w") as f:
        json.dump(doc, f)
    flat = FD.flatten_features(FD.read_feed(spark, d), seq=F.lit(7))
    assert flat.columns == FD.empty_log(spark).columns
    got = {r.place: r for r in flat.collect()}
    assert got["7 km WSW of Alderbrook, Westmark"].country == "Westmark"
    assert got["Nowhere"].country == "Nowhere"
    assert str(got["7 km WSW of Alderbrook, Westmark"].rupture_time) == "2023-11-14 22:13:20"
    assert got["Bay of Larks, Ostland"].depth == 31.0 and got["Nowhere"].ingest_seq == 7
    sel = FD.filter_feed(flat, 3, ["yellow", "orange", "red"], "2021-01-01")
    assert sel.count() == 2
    ids = [r.i for r in flat.select(FD.event_id_of(F.col("url")).alias("i")).collect()]
    assert sorted(ids) == ["q1", "q2", "q3"]


def _log(spark, rows):
    return spark.createDataFrame(rows, "seq long, event_id string, place string, mag double")


def test_keep_first_and_latest_revision(spark):
    # Two revisions of one event differ in place: keep-first on the full
    # subset keeps both; keyed by event id only the latest survives.
    log = _log(spark, [(1, "a", "3 km E of X", 5.8), (2, "b", "Y", 6.0), (3, "a", "4 km E of X", 5.8)])
    first = D.keep_first(log, ["place", "mag"], "seq")
    assert first.count() == 3
    latest = D.keep_latest(log, ["event_id"], "seq")
    assert sorted((r.event_id, r.place) for r in latest.collect()) == [("a", "4 km E of X"), ("b", "Y")]
    # Idempotent: f(f(x)) == f(x)
    again = D.keep_latest(latest, ["event_id"], "seq")
    assert sorted(again.collect()) == sorted(latest.collect())


def test_keep_first_prefers_smallest_sequence(spark):
    log = _log(spark, [(5, "a", "p", 1.0), (2, "a", "q", 1.0), (9, "a", "r", 1.0)])
    assert D.keep_first(log, ["event_id"], "seq").first().place == "q"


def test_upsert_batch_wins_ties_and_new_rows_only(spark):
    stored = _log(spark, [(1, "a", "old", 1.0), (2, "b", "keep", 1.0)])
    batch = _log(spark, [(1, "a", "new", 1.0), (3, "c", "added", 1.0)])
    up = D.upsert_latest(stored, batch, ["event_id"], "seq")
    assert sorted((r.event_id, r.place) for r in up.collect()) == [("a", "new"), ("b", "keep"), ("c", "added")]
    new = D.new_rows_only(stored, batch, ["event_id"])
    assert [r.event_id for r in new.collect()] == ["c"]


def test_retention_is_strictly_older_than(spark):
    df = spark.createDataFrame([("a", "2020-01-01 00:00:00"), ("b", "2019-12-31 23:59:59")],
                               "id string, t string").select("id", F.col("t").cast("timestamp_ntz").alias("rupture_time"))
    flagged = {r.id: r.collect_data for r in R.retention_flag(df, "2021-01-05 00:00:00", 370).collect()}
    # 2021-01-05 - 370 days = 2020-01-01 00:00: exactly 370 days is not "older".
    assert flagged == {"a": True, "b": False}
    assert [r.id for r in R.active_events(df, "2021-01-05 00:00:00", 370).collect()] == ["a"]


def test_event_log_csv_roundtrip(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(d, "log.csv")
    with open(path, "w") as f:
        f.write(",".join(FD.empty_log(spark).columns) + "\n")
        f.write('"7 km WSW of Alderbrook, Westmark",Westmark,4.6,2023-11-14 22:13:20,2,3.5,4.25,yellow,11.25,44.5,6.5,https://x/ev/q1,True,1\n')
        f.write('"Bay of Larks, Ostland",Ostland,6.1,2023-11-14 23:13:20,,5.0,6.5,red,150.125,-9.75,31.0,https://x/ev/q2,True,2\n')
    log = FD.read_event_log(spark, path)
    r = log.orderBy("magnitude").collect()
    assert r[0].place == "7 km WSW of Alderbrook, Westmark" and r[0].felt == 2
    assert r[1].felt is None and str(r[1].rupture_time) == "2023-11-14 23:13:20" and r[1].ingest_seq == 2
    assert FD.empty_log(spark).columns == log.columns


def test_event_log_times_as_text(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(d, "log.csv")
    names = FD.empty_log(spark).columns
    with open(path, "w") as f:
        f.write(",".join(names) + "\n")
        for t in ("2023/11/14 22:13:20", "2023-11-14 22:13:21", "no time"):
            f.write(",".join(t if n == "rupture_time" else "" for n in names) + "\n")
    got = [r.rupture_time for r in FD.read_event_log(spark, path, text_time=True).collect()]
    assert [str(t) for t in got] == ["2023-11-14 22:13:20", "2023-11-14 22:13:21", "None"]


def test_predictions_csv_multiline_and_trimmed_labels(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    path = os.path.join(d, "p.csv")
    with open(path, "w") as f:
        f.write(',sentence,label\n0,"Line one\nline two.",infrastructure \n1,"Plain, with ""quotes"".",other\n')
    got = FD.read_predictions_csv(spark, path).orderBy("idx").collect()
    assert got[0].sentence == "Line one\nline two." and got[0].label == "infrastructure"
    assert got[1].sentence == 'Plain, with "quotes".'


def test_partition_overwrite_is_idempotent(spark):
    from hazardlake.operators import sinks
    d = tempfile.mkdtemp(dir="/tmp")
    df = spark.createDataFrame([("2030-01-07", "Ostland", "s1"), ("2030-01-15", "Westmark", "s2")],
                               "rupture_date string, country string, sentence string")
    sinks.overwrite_partitions(df, d, ["rupture_date", "country"])
    sinks.overwrite_partitions(df.where("country = 'Westmark'"), d, ["rupture_date", "country"])
    sinks.overwrite_partitions(df.where("country = 'Westmark'"), d, ["rupture_date", "country"])
    back = spark.read.parquet(d)
    assert sorted((r.country, r.sentence) for r in back.collect()) == [("Ostland", "s1"), ("Westmark", "s2")]


def test_text_lines_keep_order_and_other_folders(spark):
    from hazardlake.operators import sinks
    path = tempfile.mkdtemp(dir="/tmp") + "/txt"
    rows = [(e, i, f"{e} line {i:03d}") for e in ("e1", "e2") for i in range(200)]
    df = spark.createDataFrame(rows, "event string, pos int, sentence string").repartition(5)
    sinks.write_text_lines(df, path, "sentence", ["event"], ["pos"])
    sinks.write_text_lines(df.where("event = 'e1'"), path, "sentence", ["event"], ["pos"])
    for e in ("e1", "e2"):
        folder = os.path.join(path, f"event={e}")
        lines = [x for f in sorted(os.listdir(folder)) if f.startswith("part-")
                 for x in open(os.path.join(folder, f)).read().splitlines()]
        assert lines == [f"{e} line {i:03d}" for i in range(200)]


def test_partitioned_write_makes_few_files(spark):
    from hazardlake.operators import sinks
    path = tempfile.mkdtemp(dir="/tmp") + "/p"
    df = spark.range(0, 4000, numPartitions=16).selectExpr("id", "id % 3 as k")
    sinks.write_partitioned(df, path, ["k"])
    files = [f for _, _, names in os.walk(path) for f in names if f.startswith("part-")]
    assert len(files) <= 6 and spark.read.parquet(path).count() == 4000


def test_merge_rewrites_only_touched_partitions(spark):
    from hazardlake.operators import sinks
    path = tempfile.mkdtemp(dir="/tmp") + "/log"
    schema = "seq long, place string, mag double, day string"

    def files(day):
        return sorted(f for f in os.listdir(os.path.join(path, f"day={day}")) if f.startswith("part-"))

    def batch(rows):
        sinks.merge_partitions(spark, path, spark.createDataFrame(rows, schema), ["place", "mag", "day"], "seq", "day")

    batch([(1, "A", 5.0, "d1"), (2, "B", 6.0, "d2")])
    untouched = files("d2")
    batch([(3, "A", 5.0, "d1"), (4, "C", 7.0, "d1")])
    batch([(3, "A", 5.0, "d1"), (4, "C", 7.0, "d1")])      # replayed: nothing changes
    got = sorted((r.seq, r.place) for r in spark.read.parquet(path).collect())
    assert got == [(1, "A"), (2, "B"), (4, "C")]            # keep-first: the stored A wins
    assert files("d2") == untouched


def test_merge_keeps_stored_rows_without_a_partition_value(spark):
    from hazardlake.operators import sinks
    path = tempfile.mkdtemp(dir="/tmp") + "/log"
    schema = "id long, seq long, day string"

    def merge(rows, latest=False):
        sinks.merge_partitions(spark, path, spark.createDataFrame(rows, schema), ["id"], "seq", "day", latest)
        return sorted((r.id, r.seq, r.day) for r in spark.read.schema(schema).parquet(path).collect())

    assert merge([(1, 1, None), (2, 1, "d1")]) == [(1, 1, None), (2, 1, "d1")]
    assert merge([(3, 2, None)]) == [(1, 1, None), (2, 1, "d1"), (3, 2, None)]
    # Text without characters is written to the same folder as null.
    assert merge([(4, 3, ""), (1, 9, None)]) == [(1, 1, None), (2, 1, "d1"), (3, 2, None), (4, 3, None)]
    assert merge([(1, 10, None)], latest=True) == [(1, 10, None), (2, 1, "d1"), (3, 2, None), (4, 3, None)]
