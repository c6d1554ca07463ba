"""Retention as a stream over the replayed events, with the DuckDB SQL of its batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from hazardlake.plans import catalog as C
from hazardlake.plans.tables import load
from hazardlake.streaming import ingest as SI
from hazardlake.streaming import retention as RT

RETENTION_DAYS, DELAY_HOURS = 10, 1


def stream_retention(spark, sf):
    """M5: all error events with the retention flag that timers, at the expiry of each event, have set in a file-stream replay."""
    schema = load(spark, sf, "events").schema
    stream = SI.read_landed(spark, sf, schema, glob="events.parquet").where(F.col("event_type") == C.HIT_TYPE)
    out, ckpt = SI.scratch_path(spark, "stream-expiries"), SI.scratch_path(spark, "stream-expiries-ckpt")
    RT.run_expiries(stream.select("event_id", "ts"), out, ckpt, "event_id", "ts", RETENTION_DAYS, f"{DELAY_HOURS} hour")
    ended = spark.read.schema("event_id long, ts timestamp_ntz, expired_at timestamp_ntz").parquet(out)
    hits = load(spark, sf, "events", "event_id", "ts", "event_type").where(F.col("event_type") == C.HIT_TYPE)
    return (hits.select("event_id").join(ended.select("event_id", F.lit(False).alias("kept")), "event_id", "left")
            .select("event_id", F.coalesce("kept", F.lit(True)).alias("collect_data")))


QUERIES = {"stream_retention": stream_retention}
ORACLE = {"stream_retention": f"""
  SELECT event_id, NOT (epoch_ms(ts) + {RETENTION_DAYS * 86_400_000} <= max(epoch_ms(ts)) OVER () - {DELAY_HOURS * 3_600_000}) AS collect_data
  FROM events WHERE event_type = '{C.HIT_TYPE}'"""}
