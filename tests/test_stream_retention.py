"""Retention by timers equals the batch rule, also over a restart."""

import datetime as dt
import random

from hazardlake.streaming import ingest as SI
from hazardlake.streaming import retention as RT

SCHEMA = "event_id long, ts timestamp_ntz"
START = dt.datetime(2024, 5, 1)


def plain(rows, days):
    """{(event, its latest time)} whose retention ends before the last watermark."""
    mark = max(t for _, t in rows) - dt.timedelta(hours=1)
    latest = {}
    for i, t in rows:
        if i is not None:
            latest[i] = max(latest.get(i, t), t)
    return sorted((i, t) for i, t in latest.items() if t + dt.timedelta(days=days) <= mark)


def test_restart_in_the_middle_equals_batch(spark):
    rng = random.Random(3)
    land, out, ckpt = (SI.scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    first = [(i, START + dt.timedelta(hours=i * 2, microseconds=rng.randint(0, 999_999))) for i in range(60)]
    second = [(100 + i, START + dt.timedelta(hours=119.5 + i)) for i in range(60)] + [(59, START + dt.timedelta(hours=130)), (58, START + dt.timedelta(hours=119.6))]
    second += [(None, START + dt.timedelta(hours=140))]

    def run(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(land)
        stream = SI.read_landed(spark, land, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
        RT.run_expiries(stream, out, ckpt, "event_id", "ts", 2, state_partitions=2)
        return sorted((r.event_id, r.ts) for r in spark.read.parquet(out).collect())

    assert run(first) == plain(first, 2)
    both = run(second)
    assert both == plain(first + second, 2) and (59, first[59][1]) not in both
    ended = {r.event_id: (r.ts, r.expired_at) for r in spark.read.parquet(out).collect()}
    assert all(abs(e - t - dt.timedelta(days=2)) < dt.timedelta(milliseconds=1) for t, e in ended.values())


def test_many_events_share_the_state_rows_of_their_buckets(spark, monkeypatch):
    """Repeated keys, revisions and several expiries in one bucket, over a restart: one state row per bucket."""
    monkeypatch.setattr(RT, "BUCKETS", 4, raising=False)
    rng = random.Random(8)
    land, out, ckpt = (SI.scratch_path(spark, n) for n in ("land", "out", "ckpt"))
    rows = [(rng.randint(-150, 150), START + dt.timedelta(minutes=rng.randint(0, 4000), microseconds=rng.randint(0, 999_999))) for _ in range(600)]
    rows.sort(key=lambda r: r[1])
    for n, part in enumerate((rows[:350], rows[350:] + [(999, START + dt.timedelta(hours=100))])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(land)
        stream = SI.read_landed(spark, land, spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
        RT.run_expiries(stream, out, ckpt, "event_id", "ts", 3, state_partitions=2)
        assert spark.read.format("statestore").load(ckpt).count() <= 4
    assert sorted((r.event_id, r.ts) for r in spark.read.parquet(out).collect()) == plain(rows + [(999, START + dt.timedelta(hours=100))], 3)
