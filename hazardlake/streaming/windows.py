"""Streaming event-time window counts (watermarked, append-safe).

Event times are NTZ UTC wall clock; the watermark column is the same clock
as a TIMESTAMP instant (``timefmt.as_instant``), so windows align to UTC
hours whatever the session time zone, and results come back as NTZ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import timefmt as TF


def windowed_counts(stream: DataFrame, ts: str, size: str, slide: str | None = None,
                    watermark: str = "1 hour", keys: list[str] | None = None) -> DataFrame:
    """(keys..., window_start, window_end, n).

    Append mode emits a window once the watermark has passed its end; update
    mode emits its count so far after each batch, the windows inside the
    watermark included (upsert them by window, the larger count wins)."""
    keys = keys or []
    s = stream.withColumn("_et", TF.as_instant(F.col(ts))).withWatermark("_et", watermark)
    w = F.window("_et", size, slide) if slide else F.window("_et", size)
    return (s.groupBy(*keys, w.alias("_w")).agg(F.count("*").alias("n"))
            .select(*keys, TF.from_instant(F.col("_w.start")).alias("window_start"),
                    TF.from_instant(F.col("_w.end")).alias("window_end"), "n"))
