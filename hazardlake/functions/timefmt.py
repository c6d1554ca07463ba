"""Time Column expressions: parsing, zones, narrative formatting.

Timestamps are stored as UTC wall clock in ``timestamp_ntz`` columns; local
time is derived per row from a zone-name column. All arithmetic here is on
NTZ values, so results do not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


EPOCH = "1970-01-01 00:00:00"


def epoch_ntz() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def epoch_ms_to_ts(ms: Column) -> Column:
    """Feed times are epoch milliseconds; keep them as UTC wall clock."""
    return F.timestamp_add("MILLISECOND", ms, epoch_ntz())


def ts_to_epoch_ms(ts: Column) -> Column:
    """UTC wall clock (NTZ) -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", epoch_ntz(), ts)


def micros_between(start: Column, end: Column) -> Column:
    """Exact microseconds from ``start`` to ``end`` (NTZ, no zone involved)."""
    return F.timestamp_diff("MICROSECOND", start, end)


def as_instant(ts: Column) -> Column:
    """NTZ UTC wall clock -> TIMESTAMP instant, whatever the session zone
    (streaming watermarks need a TIMESTAMP column)."""
    return F.timestamp_micros(micros_between(epoch_ntz(), ts.cast("timestamp_ntz")))


def from_instant(ts: Column) -> Column:
    """TIMESTAMP instant -> NTZ UTC wall clock, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch_ntz())


def parse_log_time(text: Column) -> Column:
    """``2021/08/14 20:20:45`` or ``2021-08-14 20:20:45`` -> timestamp; null if it is none."""
    return F.translate(text, "/", "-").try_cast("timestamp_ntz")


def local_time(utc_ts: Column, zone: Column) -> Column:
    """UTC wall clock -> wall clock in ``zone`` (DST aware), as NTZ."""
    return F.convert_timezone(F.lit("UTC"), zone, utc_ts.cast("timestamp_ntz"))


def day_key(ts: Column) -> Column:
    """Calendar date of a rupture time (partition / join key)."""
    return F.to_date(ts)


def path_time(ts: Column) -> Column:
    """Path-safe time: date, underscore, time (no ``/`` and no space)."""
    return F.concat(F.to_date(ts).cast("string"), F.lit("_"), clock(ts), F.lit(":"), _two(F.second(ts)))


def narrative_date(ts: Column) -> Column:
    """``September 15, 2021`` (unpadded day). Formatted from the date: a wall
    clock time that the session zone skips would be moved."""
    return F.date_format(F.to_date(ts), "MMMM d, yyyy")


def clock(ts: Column) -> Column:
    """``21:05`` (zero-padded hour and minute)."""
    return F.concat(_two(F.hour(ts)), F.lit(":"), _two(F.minute(ts)))


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def older_than(ts: Column, asof: str, days: int) -> Column:
    """True where ``asof - ts`` is strictly longer than ``days`` days.

    Written as ``ts < asof - days`` so the bound constant-folds and reaches
    the parquet scan as a pushed filter.
    """
    bound = F.lit(asof).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return ts < bound
