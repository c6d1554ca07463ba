"""Retention as a stream: every event is remembered until its time is up, then reported and forgotten.

The state holds the active events only: each with its latest time, in the row of its bucket of keys. The bucket's
timer stands at the earliest expiry in it; when the watermark passes that, the events whose time is up are emitted and
leave the state, and the timer moves to the next expiry. A later revision of an event moves its expiry. One
call of Python and one access to the state serve a bucket; with a state and a timer for each key alone, both would be paid per event.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from hazardlake.functions import timefmt as TF
from hazardlake.streaming.ingest import run_available_now

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


#: Groups of event keys that share a call, a state row and a timer.
BUCKETS = 1024


def expiry(days: int):
    """Rows (key, us) of one bucket -> (key, us, expired_ms) of each key, ``days`` after its latest time."""
    keep_ms = days * 86_400_000

    def step(bucket: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [np.frombuffer(b, "<i8") for b in state.get] if state.exists else [np.empty(0, "<i8")] * 2
        active = pd.Series(held[1], index=held[0])
        if not state.hasTimedOut:
            for rows in frames:
                new = pd.Series(rows["us"].to_numpy(), index=rows["key"].to_numpy())
                active = pd.concat([active, new]).groupby(level=0).max()
        ends = active // 1000 + keep_ms
        over = ends <= state.getCurrentWatermarkMs()
        if over.all():
            state.remove()
        else:
            left = active[~over]
            state.update((left.index.to_numpy("<i8").tobytes(), left.to_numpy("<i8").tobytes()))
            state.setTimeoutTimestamp(int(ends[~over].min()) - 1)     # a timer fires once the watermark is beyond it
        if over.any():
            yield pd.DataFrame({"key": active.index[over], "us": active[over].to_numpy(), "expired_ms": ends[over].to_numpy()})
    return step


def expiries(stream: DataFrame, key: str, ts: str, days: int, watermark: str = "1 hour") -> DataFrame:
    """(key, ts, expired_at) of the events whose retention has ended; key is a long, ts an NTZ time.

    An event ends when the watermark (largest time seen less the delay) reaches its time plus ``days``, in
    milliseconds. Rows without key or time are left out.
    """
    timed = (stream.select(F.col(key).cast("long").alias("key"), TF.as_instant(F.col(ts)).alias("_at"))
             .where("key is not null and _at is not null").withWatermark("_at", watermark)
             .select("*", F.unix_micros("_at").alias("us"), F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).alias("bucket")))
    out = timed.groupBy("bucket").applyInPandasWithState(
        expiry(days), outputStructType="key long, us long, expired_ms long", stateStructType="keys binary, times binary",
        outputMode="append", timeoutConf=GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("key").alias(key), F.timestamp_add("MICROSECOND", F.col("us"), TF.epoch_ntz()).alias(ts),
                      TF.epoch_ms_to_ts(F.col("expired_ms")).alias("expired_at"))


def run_expiries(stream: DataFrame, out_path: str, checkpoint: str, key: str, ts: str, days: int,
                 watermark: str = "1 hour", state_partitions: int | None = None) -> None:
    """Process what is available and append the expiries; a later run with the same checkpoint goes on where it stopped.

    The active events lie in the RocksDB state store, outside the heap; it is set for the start of this query only.
    """
    spark, setting = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, STATE_STORE)
    try:
        run_available_now(expiries(stream, key, ts, days, watermark), out_path, checkpoint,
                          state_partitions=state_partitions)
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)
