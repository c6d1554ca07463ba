"""Sinks: partitioned tables, idempotent rewrites."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlake.operators.common import checkpoint, rank_within_groups
from hazardlake.operators.dedupe import merge_log, upsert_latest


MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_by: list[str],
                      mode: str = "append", fmt: str = "parquet") -> None:
    """One folder per partition value (the per-event files of the source).

    Rows are rebalanced by the partition columns first, so a folder gets a
    file per advisory partition size of its data, not one per task; Spark splits large values over tasks.
    """
    (df.hint("rebalance", *partition_by).write.mode(mode).format(fmt)
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*partition_by).save(path))


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str],
                         fmt: str = "parquet") -> None:
    """Re-runs replace only the partitions they produce (idempotent)."""
    (df.hint("rebalance", *partition_by).write.mode("overwrite").format(fmt)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy(*partition_by).save(path))


def write_text_lines(df: DataFrame, path: str, text_col: str, partition_by: list[str],
                     order: list[str] | None = None) -> None:
    """Plain-text files, one line per row, one folder per partition.

    A re-run replaces only the folders it writes. ``order`` sorts the lines:
    rows are range-partitioned by folder and order, so the files of a folder,
    by name, hold its lines in order.
    """
    keys = [*partition_by, *(order or [])]
    (df.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*partition_by, text_col)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).text(path))


def write_predictions(df: DataFrame, path: str, partition_by: list[str], order: list[str], sentence: str = "sentence",
                      label: str = "label") -> None:
    """Classified sentences as quoted CSV (idx, sentence, label), one folder per key, the form that
    ``read_predictions_csv`` reads.

    ``idx`` numbers the rows of a folder from 0 in ``order`` (which must be a total order inside the folder); a re-run
    replaces only the folders it writes. Quotes are doubled and line breaks kept inside quoted values.
    """
    ranked = rank_within_groups(df.select(*partition_by, *order, sentence, label), partition_by, [F.asc(c) for c in order], "_n")
    rows = ranked.select(*partition_by, (F.col("_n") - 1).cast("int").alias("idx"), F.col(sentence).alias("sentence"),
                         F.col(label).alias("label"))
    (rows.repartitionByRange(*partition_by, "idx").sortWithinPartitions(*partition_by, "idx").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).partitionBy(*partition_by).csv(path))


def merge_partitions(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], seq: str,
                     partition_by: str, latest: bool = False, schema: T.StructType | None = None) -> None:
    """Merge ``batch`` into the table at ``path`` and rewrite only the partitions it touches.

    Keeps the first row per key (the log's rule) or with ``latest`` the latest
    revision. ``partition_by`` must be a function of the key, so that all
    revisions of a key share a partition. New files are written beside the
    old ones and swapped per partition at commit; merging one batch twice
    changes nothing. Rows without a partition value share one folder; an empty text
    is no value there (both are written to the default folder).
    """
    if dict(batch.dtypes)[partition_by] == "string":
        batch = batch.withColumn(partition_by, F.nullif(partition_by, F.lit("")))
    batch = batch.select(*[c for c in batch.columns if c != partition_by], partition_by)
    stored = batch.limit(0)
    if path_exists(spark, path):
        stored = spark.read.schema(schema or batch.schema).option("basePath", path).parquet(path)
        touched = batch.select(F.col(partition_by).alias("_touched")).distinct()
        same = stored[partition_by].eqNullSafe(touched["_touched"])
        # Written first: the plan may not read files that the commit replaces.
        stored = checkpoint(stored.join(touched, same, "left_semi").select(*batch.columns))
    merged = (upsert_latest if latest else merge_log)(stored, batch, keys, seq)
    overwrite_partitions(merged, path, [partition_by])


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
