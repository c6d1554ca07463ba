"""Written intermediate tables in the shared checkpoint folder.

A written table cuts lineage and outlives lost executors. Folders are under
``spark.checkpoint.dir``; ``drop`` removes one that no later plan reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlake.session import ensure_checkpoint_dir

#: A side is broadcast only when rows x row bytes stay within this bound.
BROADCAST_BYTES = 16 << 20


def new_path(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm_{label}_{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the DataFrame that reads it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in frames:
        path = getattr(df, "_staged_path", None)
        if path:
            delete_path(df.sparkSession, path)


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def bounded(df: DataFrame, row_bytes: int, rows: int | None = None) -> DataFrame:
    """Mark staged ``df`` for broadcast if its size is within BROADCAST_BYTES.

    Beyond the bound the hint is left out and Spark shuffles the join.
    """
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
