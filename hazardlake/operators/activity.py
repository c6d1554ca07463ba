"""Activity over event time: window counts, bursts, resilience curves.

Batch forms of the Structured Streaming operators in
``hazardlake.streaming``; both share the same window definitions so a
stream replay equals the batch result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.functions import text as T
from hazardlake.functions import timefmt as TF
from hazardlake.operators.common import checkpoint, spread


def window_counts(df: DataFrame, ts: str, size: str, slide: str | None = None,
                  keys: list[str] | None = None) -> DataFrame:
    """(keys..., window_start, window_end, n) for tumbling or sliding windows."""
    keys = keys or []
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (df.groupBy(*keys, w.alias("_w")).agg(F.count("*").alias("n"))
            .select(*keys, F.col("_w.start").alias("window_start"),
                    F.col("_w.end").alias("window_end"), "n"))


def _breaks(df: DataFrame, by: list, prev: str, cur: str, gap_us: int) -> DataFrame:
    """Adds ``_sid``: number of quiet gaps so far within ``by``, in order of ``cur``."""
    w = Window.partitionBy(*by).orderBy(cur)
    quiet = TF.micros_between(F.lag(prev).over(w), F.col(cur)) > gap_us
    fresh = df.withColumn("_new", F.coalesce(quiet, F.lit(False)).cast("int"))
    return fresh.withColumn("_sid", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def _micros(interval: str) -> int:
    """Microseconds of ``<number> <unit>``."""
    number, unit = interval.split()
    seconds = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(float(number) * seconds * 1_000_000)


def session_counts(df: DataFrame, ts: str, gap: str, keys: list[str], bucket: str = "day") -> DataFrame:
    """(keys..., session_start, session_end, n): bursts split by ``gap`` of quiet.

    Same result as ``groupBy(keys, session_window(ts, gap))``, which
    sessionises each key inside one task. Here the events of a key are first
    sessionised per time ``bucket``, so a key holding a third of the rows
    spreads over its buckets; the few sessions of the buckets are then joined
    per key by the same rule. A session end is its last event + gap.
    """
    gap_us = _micros(gap)
    src = df.select(*keys, ts).where(F.col(ts).isNotNull()).withColumn("_b", F.date_trunc(bucket, F.col(ts)))
    parts = (_breaks(src, [*keys, "_b"], ts, ts, gap_us).groupBy(*keys, "_b", "_sid")
             .agg(F.min(ts).alias("_start"), F.max(ts).alias("_stop"), F.count("*").alias("_n")))
    return (_breaks(parts.drop("_sid"), keys, "_stop", "_start", gap_us).groupBy(*keys, "_sid")
            .agg(F.min("_start").alias("session_start"), F.max("_stop").alias("_stop"), F.sum("_n").alias("n"))
            .select(*keys, "session_start",
                    (F.col("_stop") + F.expr(f"INTERVAL {gap}")).alias("session_end"), "n"))


def _hours_after(rupture, ts):
    """Whole hours from the rupture to ``ts``, rounded down."""
    return F.floor(TF.micros_between(rupture, ts) / F.lit(3_600_000_000)).cast("int")


def resilience_curve(hits: DataFrame, ts: str, keys: list[str], rupture: str,
                     before_h: int = 72, after_h: int | None = None, k_sd: float = 2.0,
                     recover_h: int = 6, digits: int = 6) -> DataFrame:
    """(keys..., baseline_mean, baseline_sd, t0, t1, recovery_h) per curve.

    ``hits`` are rows already matching the curve's keywords. Hourly counts
    ``y(h)`` for hour offsets ``h`` from ``-before_h`` to ``recover_h`` hours
    after the curve's last hit (or up to ``after_h`` if given) are
    zero-filled from a ``sequence`` spine. Baseline = mean
    and population sd of ``y`` over the hours before the rupture.
    ``t0`` = first ``h >= 0`` with ``y > mean + k_sd * sd``; ``t1`` = first
    ``h > t0`` whose trailing ``recover_h``-hour mean is ``<= mean``;
    ``recovery_h = t1 - t0`` (null when either is missing). A curve has one
    row per hour, whatever the number of hits; null keys are a curve.
    """
    hours = hits.select(*keys, _hours_after(F.lit(rupture).cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz")).alias("h"))
    ends = hours.groupBy(*keys).agg(F.max("h").alias("_last"))
    if after_h is not None:
        hours, last = hours.where(F.col("h") < after_h), F.lit(after_h - 1)
    else:
        last = F.greatest(F.col("_last"), F.lit(0)) + recover_h
    counts = hours.where(F.col("h") >= -before_h).groupBy(*keys, "h").agg(F.count("*").alias("y"))
    return _recovery(ends.select(*keys, last.alias("_stop")), counts, keys, before_h, k_sd, recover_h, digits)


def _recovery(curves: DataFrame, counts: DataFrame, keys: list[str], before_h: int, k_sd: float, recover_h: int,
              digits: int) -> DataFrame:
    """Baseline, t0, t1 and recovery of the curves (keys..., _stop: last hour) from their counts (keys..., h, y)."""
    spine = curves.select(*keys, F.explode(F.sequence(F.lit(-before_h), F.col("_stop"))).alias("h"))
    curve = (_null_safe_left(spine, counts, keys + ["h"])
             .select(*keys, "h", F.coalesce("y", F.lit(0)).cast("double").alias("y")))
    base = Window.partitionBy(*keys)
    before = F.when(F.col("h") < 0, F.col("y"))
    trail = Window.partitionBy(*keys).orderBy("h").rowsBetween(-(recover_h - 1), 0)
    c = curve.select("*", F.avg(before).over(base).alias("_m"), F.stddev_pop(before).over(base).alias("_sd"),
                     F.avg("y").over(trail).alias("_trail"))
    high = (F.col("h") >= 0) & (F.col("y") > F.col("_m") + k_sd * F.col("_sd"))
    c = c.withColumn("t0", F.min(F.when(high, F.col("h"))).over(base))
    low = (F.col("h") > F.col("t0")) & (F.col("_trail") <= F.col("_m"))
    return (c.groupBy(*keys).agg(F.first("_m").alias("_m"), F.first("_sd").alias("_sd"), F.first("t0").alias("t0"),
                                 F.min(F.when(low, F.col("h"))).alias("t1"))
            .select(*keys, F.round("_m", digits).alias("baseline_mean"),
                    F.round("_sd", digits).alias("baseline_sd"), "t0", "t1",
                    (F.col("t1") - F.col("t0")).alias("recovery_h")))


def event_resilience(events: DataFrame, posts: DataFrame, event_key: str, rupture: str, keywords: str,
                     post_key: str, ts: str, text_col: str, before_h: int = 72, after_h: int = 120,
                     k_sd: float = 2.0, recover_h: int = 6, digits: int = 6) -> DataFrame:
    """(event_key, n_hits, baseline_mean, baseline_sd, t0, t1, recovery_h) of every event.

    An event has its own time ``rupture`` and an array of lower-case ``keywords``; its hits are the posts with any of them
    from ``before_h`` hours before to ``after_h`` hours after it. The interval join is an equi-join on
    (token, day): posts are an inverted index of the tokens asked for, an event lists the days
    that its interval touches, and the exact bounds are the residual. A post with several keywords counts
    once. Events without hits have a flat curve; events without a time are left out.
    """
    ev = events.where(F.col(rupture).isNotNull()).select(event_key, F.col(rupture).cast("timestamp_ntz").alias("_t"), keywords)
    start = F.timestamp_add("HOUR", F.lit(-before_h), F.col("_t"))
    stop = F.timestamp_add("HOUR", F.lit(after_h), F.col("_t"))
    days = F.sequence(F.to_date(start), F.to_date(stop))
    asked = (ev.select(event_key, "_t", days.alias("_days"), F.explode(F.array_distinct(keywords)).alias("token"))
             .select(event_key, "_t", "token", F.explode("_days").alias("_day")))
    words = (spread(posts.where(F.col(ts).isNotNull()).select(post_key, ts, text_col))
             .select(post_key, F.col(ts).cast("timestamp_ntz").alias("_at"), F.explode(F.array_distinct(T.tokens(F.col(text_col)))).alias("token"))
             .join(asked.select("token").distinct(), "token", "left_semi").withColumn("_day", F.to_date("_at")))
    hour = _hours_after(F.col("_t"), F.col("_at"))
    hits = (asked.join(words, ["token", "_day"]).select(event_key, post_key, hour.alias("h"))
            .where((F.col("h") >= -before_h) & (F.col("h") < after_h)).distinct())
    counts = hits.groupBy(event_key, "h").agg(F.count("*").alias("y"))
    found = _recovery(ev.select(event_key, F.lit(after_h - 1).alias("_stop")).distinct(), checkpoint(counts), [event_key],
                      before_h, k_sd, recover_h, digits)
    total = counts.groupBy(F.col(event_key).alias("_k")).agg(F.sum("y").alias("n_hits"))
    return (found.join(total, F.col(event_key).eqNullSafe(F.col("_k")), "left")
            .select(event_key, F.coalesce("n_hits", F.lit(0)).alias("n_hits"), "baseline_mean", "baseline_sd", "t0", "t1", "recovery_h"))


def _null_safe_left(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on ``keys`` where null equals null; keys come from ``a``."""
    right = b.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                     *[c for c in b.columns if c not in keys])
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)])
    return a.join(right, same, "left").drop(*[f"_r{i}" for i in range(len(keys))])
