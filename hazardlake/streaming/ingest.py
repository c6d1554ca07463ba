"""Incremental ingest with Structured Streaming.

The daily "query since a date, append, de-duplicate" loop becomes a file
stream over the landing folder run with ``trigger(availableNow=True)``:
each run processes exactly the files that arrived since the last one (the
checkpoint remembers), then stops. State for de-duplication is bounded by a
watermark; rows later than the watermark are dropped, by design.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.functions import timefmt as TF
from hazardlake.operators.common import checkpoint as cut
from hazardlake.operators.sinks import merge_partitions
from hazardlake.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def read_landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """A file stream over the landing folder ``path`` (files matching ``glob``)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def dedupe_stream(stream: DataFrame, ts: str, keys: list[str], watermark: str) -> DataFrame:
    """Drop repeats of ``keys`` seen within the watermark delay.

    A watermark needs a TIMESTAMP (not NTZ) event-time column: it gets its
    own column, so the key columns keep their (NTZ) values untouched.
    """
    s = stream.withColumn("_event_time", TF.as_instant(F.col(ts)))
    return (s.withWatermark("_event_time", watermark).dropDuplicatesWithinWatermark(keys)
            .drop("_event_time"))


def run_available_now(stream: DataFrame, out_path: str, checkpoint: str,
                      fmt: str = "parquet", partition_by: list[str] | None = None,
                      state_partitions: int | None = None) -> None:
    """Process everything that is available, write it exactly once, stop.

    A stateful stream fixes its number of state partitions when it first
    starts (AQE does not resize them), from ``spark.sql.shuffle.partitions``.
    They are set explicitly here -- by default the cluster's parallelism --
    for the start only; the session value is restored right after. On a
    restart the count recorded in the checkpoint wins.
    """
    spark = stream.sparkSession
    w = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", out_path)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    _start(spark, w, state_partitions).awaitTermination()


def _start(spark: SparkSession, writer, state_partitions: int | None):
    """Start a stream with its number of state partitions; the session value is restored."""
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions or spark.sparkContext.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def upsert_batches(stream: DataFrame, table_path: str, checkpoint: str, keys: list[str],
                   seq: str, partition_by: str, output_mode: str = "append",
                   state_partitions: int | None = None) -> None:
    """Keep a latest-revision table current with ``foreachBatch``.

    Each micro-batch is merged into the touched partitions only (latest
    ``seq`` per key); a replayed batch changes nothing. ``partition_by`` is a
    function of the key.
    """
    def merge(batch: DataFrame, epoch: int) -> None:
        # The merge reads the batch more than once; stateful plans must run once.
        batch = cut(batch)
        merge_partitions(batch.sparkSession, table_path, batch, keys, seq, partition_by, latest=True)

    w = (stream.writeStream.foreachBatch(merge).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    _start(stream.sparkSession, w, state_partitions).awaitTermination()
