"""Keyed de-duplication of the event log.

"Keep the first" and "keep the latest revision" are ``row_number() = 1``
windows, which Spark plans with a partial WindowGroupLimit before the
shuffle: a key holding a third of all rows still ships one row per map task.
An explicit sequence column decides "first"; ``dropDuplicates`` (arbitrary
survivor) is never used for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlake.operators.common import top_n_per_key


def _pick(df: DataFrame, keys: list[str], order_cols: list[str], latest: bool) -> DataFrame:
    order = [F.col(c).desc_nulls_last() if latest else F.col(c).asc_nulls_last() for c in order_cols]
    return top_n_per_key(df, keys, order, 1)


def keep_first(df: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """One row per key: the one with the smallest ``seq`` (ingest order)."""
    return _pick(df, keys, [seq] if isinstance(seq, str) else list(seq), latest=False)


def keep_latest(df: DataFrame, keys: list[str], seq: str | list[str]) -> DataFrame:
    """One row per key: the one with the largest ``seq`` (latest revision)."""
    return _pick(df, keys, [seq] if isinstance(seq, str) else list(seq), latest=True)


def merge_log(log: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Append a batch to the log and keep the first row per key."""
    return keep_first(log.unionByName(batch), keys, seq)


def upsert_latest(log: DataFrame, batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Log + batch, latest revision per key; on equal ``seq`` the batch wins."""
    both = (log.withColumn("_src", F.lit(0))
            .unionByName(batch.withColumn("_src", F.lit(1))))
    return keep_latest(both, keys, [seq, "_src"]).drop("_src")


def new_rows_only(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet (left-anti join)."""
    return incoming.join(existing.select(*keys), keys, "left_anti")
