import os
import tempfile

from pyspark.sql import functions as F

from hazardlake.operators import activity as AC
from hazardlake.streaming import ingest as SI
from hazardlake.streaming import windows as SW


def _events(spark, times, user=1):
    return spark.createDataFrame([(user, t) for t in times], "user_id int, t string") \
        .select("user_id", F.col("t").cast("timestamp_ntz").alias("ts"))


def test_tumbling_sliding_and_sessions(spark):
    ev = _events(spark, ["2024-01-01 00:10:00", "2024-01-01 00:50:00", "2024-01-01 01:05:00",
                         "2024-01-01 03:00:00"])
    tum = sorted((str(r.window_start), r.n) for r in AC.window_counts(ev, "ts", "1 hour").collect())
    assert tum == [("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 1), ("2024-01-01 03:00:00", 1)]
    sl = AC.window_counts(ev, "ts", "1 hour", "15 minutes")
    assert sl.agg(F.sum("n")).first()[0] == 4 * 4
    ses = sorted((str(r.session_start), str(r.session_end), r.n)
                 for r in AC.session_counts(ev, "ts", "30 minutes", ["user_id"]).collect())
    assert ses == [("2024-01-01 00:10:00", "2024-01-01 00:40:00", 1),
                   ("2024-01-01 00:50:00", "2024-01-01 01:35:00", 2),
                   ("2024-01-01 03:00:00", "2024-01-01 03:30:00", 1)]


def test_resilience_curve_definition(spark):
    base = [f"2024-01-0{d} {h:02d}:30:00" for d in (1, 2, 3) for h in range(24)]      # 1/hour before
    burst = ["2024-01-04 02:10:00"] * 8 + ["2024-01-04 03:10:00"] * 5               # spike at h=2
    after = [f"2024-01-04 {h:02d}:40:00" for h in range(4, 10) if h % 2 == 0]          # quiet after
    ev = _events(spark, base + burst + after).withColumn("k", F.lit("power"))
    r = AC.resilience_curve(ev, "ts", ["k"], "2024-01-04 00:00:00", before_h=72, after_h=48).first()
    assert r.baseline_mean == 1.0 and r.baseline_sd == 0.0
    assert r.t0 == 2
    late = AC.resilience_curve(ev, "ts", ["k"], "2024-01-04 00:00:00").first()
    assert (late.t0, late.t1) == (2, 9)
    # trailing 6h means after t0: h=8 -> (5+1+0+1+0+1)/6 > 1, h=9 -> 3/6 <= 1
    assert r.t1 == 9 and r.recovery_h == 7


def test_recovery_long_after_the_rupture_and_null_keys(spark):
    base = [f"2024-01-0{d} {h:02d}:30:00" for d in (1, 2, 3) for h in range(24)]
    high = [f"2024-01-{4 + d:02d} {h:02d}:{m}0:00" for d in range(12) for h in range(24) for m in (1, 2, 3)]
    ev = _events(spark, base + high).withColumn("k", F.lit(None).cast("string"))
    r = AC.resilience_curve(ev, "ts", ["k"], "2024-01-04 00:00:00").first()
    # Three an hour for 288 hours, then silence: the trailing mean falls to 1 four hours after the last hit.
    assert r.k is None and r.t0 == 0 and r.t1 == 291


def test_sessions_with_null_and_large_keys_and_buckets(spark):
    rows = [(None, "2024-01-01 23:59:30"), (None, "2024-01-02 00:00:20"), (9007199254740993, "2024-01-01 10:00:00"),
            (9007199254740992, "2024-01-01 10:10:00"), (5, "2024-01-01 23:50:00"), (5, "2024-01-02 00:30:00"),
            (5, "2024-01-02 00:20:00"), (5, None)]
    df = spark.createDataFrame(rows, "user_id long, t string").select(
        "user_id", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = sorted((str(r[0]), str(r[1]), str(r[2]), r[3]) for r in AC.session_counts(df, "ts", "30 minutes", ["user_id"]).collect())
    want = sorted((str(r[0]), str(r[1]), str(r[2]), r[3]) for r in
                  df.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s")).agg(F.count("*").alias("n"))
                  .select("user_id", F.col("s.start"), F.col("s.end"), "n").collect())
    assert got == want


def test_stream_dedupe_equals_batch(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    rows = [(1, "a", "2024-01-01 00:00:10"), (1, "a", "2024-01-01 00:00:50"), (2, "b", "2024-01-01 00:01:00")]
    df = spark.createDataFrame(rows, "user_id int, kind string, t string") \
        .select("user_id", "kind", F.col("t").cast("timestamp_ntz").alias("ts"))
    df.write.parquet(os.path.join(d, "in"))
    stream = SI.read_landed(spark, os.path.join(d, "in"), df.schema) \
        .withColumn("minute", F.date_trunc("minute", F.col("ts").cast("timestamp")))
    out, ck = SI.scratch_path(spark, "o"), SI.scratch_path(spark, "c")
    SI.run_available_now(SI.dedupe_stream(stream, "minute", ["user_id", "kind", "minute"], "1 hour")
                         .select("user_id", "kind"), out, ck)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a"), (2, "b")]


def test_streaming_window_counts_equal_batch_on_closed_windows(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    first = _events(spark, ["2024-01-01 00:10:00", "2024-01-01 00:20:00", "2024-01-01 01:30:00"])
    later = _events(spark, ["2024-01-01 05:00:00"])
    # One part file per landed batch; the file source orders files by
    # modification time, so make f2 strictly later than f1.
    first.coalesce(1).write.parquet(os.path.join(d, "in", "f1"))
    later.coalesce(1).write.parquet(os.path.join(d, "in", "f2"))
    import time as _t
    for name in os.listdir(os.path.join(d, "in", "f2")):
        later_ts = _t.time() + 60
        os.utime(os.path.join(d, "in", "f2", name), (later_ts, later_ts))
    stream = SI.read_landed(spark, os.path.join(d, "in") + "/*", first.schema, max_files_per_trigger=1)
    agg = SW.windowed_counts(stream, "ts", "1 hour", watermark="10 minutes")
    q = (agg.writeStream.format("memory").queryName("wc_test").outputMode("append")
         .option("checkpointLocation", SI.scratch_path(spark, "wc")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((str(r.window_start), r.n) for r in spark.table("wc_test").collect())
    # Watermark after the second file: 04:50 -> the windows ending by then are final.
    batch = AC.window_counts(first.unionByName(later), "ts", "1 hour")
    want = sorted((str(r.window_start), r.n) for r in batch.where("window_end <= '2024-01-01 04:50:00'").collect())
    assert got == want == [("2024-01-01 00:00:00", 2), ("2024-01-01 01:00:00", 1)]


def test_distributed_sessions_equal_session_window(spark):
    import random
    rnd = random.Random(11)
    rows = []
    for u in range(6):
        n = 4000 if u == 0 else 150            # user 0 is a hot key
        t = 0
        for _ in range(n):
            t += rnd.choice([30, 60, 600, 1700, 1900, 4000])
            rows.append((u, t))
    df = spark.createDataFrame(rows, "user_id int, sec long").select(
        "user_id", F.timestamp_seconds("sec").cast("timestamp_ntz").alias("ts")).repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = sorted(tuple(r) for r in AC.session_counts(df, "ts", "30 minutes", ["user_id"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted(tuple(r) for r in df.groupBy("user_id", F.session_window("ts", "30 minutes").alias("s"))
                  .agg(F.count("*").alias("n"))
                  .select("user_id", F.col("s.start"), F.col("s.end"), "n").collect())
    assert got == want


def test_foreach_batch_upsert_survives_restart(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    land, table, ck = os.path.join(d, "land"), os.path.join(d, "table"), os.path.join(d, "ck")
    schema = "event_id string, seq long, place string, part int"
    spark.createDataFrame([("a", 1, "first", 0), ("b", 1, "bee", 1)], schema).write.parquet(os.path.join(land, "f1"))

    def run():
        s = SI.read_landed(spark, land + "/*", spark.createDataFrame([], schema).schema)
        SI.upsert_batches(s, table, ck, ["event_id"], "seq", "part")

    run()
    # A new file lands; a fresh run (new driver state) resumes from the checkpoint.
    spark.createDataFrame([("a", 2, "revised", 0), ("c", 1, "sea", 0)], schema).write.parquet(os.path.join(land, "f2"))
    run()
    got = sorted((r.event_id, r.place) for r in spark.read.parquet(table).collect())
    assert got == [("a", "revised"), ("b", "bee"), ("c", "sea")]


def test_update_mode_windows_upserted_equal_batch(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    ev = _events(spark, ["2024-01-01 00:10:00", "2024-01-01 00:20:00", "2024-01-01 01:30:00", "2024-01-01 05:00:00"])
    ev.coalesce(1).write.parquet(os.path.join(d, "in"))
    stream = SI.read_landed(spark, os.path.join(d, "in"), ev.schema)
    agg = SW.windowed_counts(stream, "ts", "1 hour", watermark="10 minutes").withColumn("p", F.to_date("window_start").cast("string"))
    out = os.path.join(d, "out")
    SI.upsert_batches(agg, out, os.path.join(d, "ck"), ["window_start"], "n", "p", output_mode="update")
    got = sorted((str(r.window_start), r.n) for r in spark.read.parquet(out).collect())
    assert got == sorted((str(r.window_start), r.n) for r in AC.window_counts(ev, "ts", "1 hour").collect())


def test_time_helpers(spark):
    from hazardlake.functions import timefmt as TF
    from hazardlake.operators import retention as R
    df = spark.createDataFrame([("2031/02/03 04:05:06",)], "t string")
    r = df.select(TF.parse_log_time(F.col("t")).alias("ts"),
                  R.query_start("2031-04-11 00:00:00", 67).alias("d"),
                  TF.path_time(TF.parse_log_time(F.col("t"))).alias("p")).first()
    assert str(r.ts) == "2031-02-03 04:05:06" and str(r.d) == "2031-02-03" and r.p == "2031-02-03_04:05:06"
