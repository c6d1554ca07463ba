"""Retention: which events are still collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.functions import timefmt as TF


def retention_flag(log: DataFrame, asof: str, days: int, time_col: str = "rupture_time",
                   flag_col: str = "collect_data") -> DataFrame:
    """``flag_col`` becomes False for events older than ``days`` before ``asof``.

    ``asof`` is a job parameter (never ``now()``) so re-runs are repeatable.
    A row already flagged False stays False.
    """
    old = TF.older_than(F.col(time_col), asof, days)
    prior = F.col(flag_col) if flag_col in log.columns else F.lit(True)
    return log.withColumn(flag_col, F.when(old, F.lit(False)).otherwise(prior))


def active_events(log: DataFrame, asof: str, days: int, time_col: str = "rupture_time",
                  flag_col: str = "collect_data") -> DataFrame:
    """Events still inside the retention window.

    Expressed as the plain range predicate so it reaches the parquet scan.
    """
    keep = ~TF.older_than(F.col(time_col), asof, days)
    if flag_col in log.columns:
        keep = keep & F.col(flag_col)
    return log.where(keep)


def query_start(asof: str, days_back: int):
    """The feed query's start date: ``asof`` minus ``days_back`` days."""
    return F.date_sub(F.lit(asof).cast("date"), days_back)
