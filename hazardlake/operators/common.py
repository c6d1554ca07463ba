"""Small plan helpers shared by the operators."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hazardlake.session import ensure_checkpoint_dir


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster when it arrives in too few partitions.

    For CPU-heavy per-row work (HTML regexes, sentence splitting,
    tokenising) on a source read as a handful of splits. When the input
    already has at least ``defaultParallelism`` partitions -- the normal case
    on a large input -- this is a no-op and adds no shuffle.

    Apply it to a source scan (or a narrow projection of one): its
    partition count is known from the file splits. On an input that already
    contains a shuffle, asking for the partition count would run the
    upstream stages ahead of time.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df


def top_n_per_key(df: DataFrame, keys: list[str], order: list, n: int,
                  rank_col: str | None = None, offset: int = 0) -> DataFrame:
    """Rows ranked ``offset+1 .. offset+n`` per key under ``order``.

    ``row_number() <= k`` with a literal ``k`` is planned with a partial
    WindowGroupLimit before the shuffle, so each map task forwards at most
    ``k`` rows per key: a hot key does not pile up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = rank_col or "_rn"
    out = (df.withColumn(rn, F.row_number().over(w))
           .where(F.col(rn) <= offset + n))
    if offset:
        out = out.where(F.col(rn) > offset)
    return out if rank_col else out.drop(rn)


def rank_within_groups(df: DataFrame, keys: list[str], order: list, pos_col: str = "_pos") -> DataFrame:
    """Add ``pos_col``: the 1-based position of each row inside its group
    under ``order`` (which must be a total order, e.g. end with a unique id).

    A window would sort each group inside one task; a group holding a third
    of the rows would then sit in one task. Instead the rows are globally
    range-sorted (a large group spreads over many partitions), numbered
    inside each partition, and each (group, partition) slice gets the count
    of the group's rows in earlier partitions as an offset. The slice table
    has at most #groups + #partitions rows. The numbered rows are
    checkpointed so a recomputation can never renumber them.
    """
    s = df.orderBy(*[F.col(k) for k in keys], *order)
    s = checkpoint(s.withColumn("_pid", F.spark_partition_id())
                   .withColumn("_mid", F.monotonically_increasing_id()))
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = (s.groupBy(*keys, "_pid").agg(F.min("_mid").alias("_m0"), F.count("*").alias("_c"))
              .withColumn("_off", F.coalesce(F.sum("_c").over(before), F.lit(0)))
              .drop("_c"))
    right = slices.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], F.col("_pid").alias("_rp"),
                          "_m0", "_off")
    same = reduce(lambda a, b: a & b, [F.col("_pid") == F.col("_rp")] + [
        F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)])
    return (s.join(right, same).drop("_rp", *[f"_r{i}" for i in range(len(keys))])
            .withColumn(pos_col, F.col("_off") + F.col("_mid") - F.col("_m0") + 1)
            .drop("_pid", "_mid", "_m0", "_off"))


def bucketed_copy(df: DataFrame, cols: list[str], buckets: int, label: str):
    """Write ``df`` once as a table bucketed by ``cols`` under the shared
    checkpoint folder and return (table DataFrame, table name).

    For a large table joined again and again on the same key (iterations):
    the bucketed scan reports its hash partitioning, so each join shuffles
    only the other, smaller side; the files also outlive lost executors.
    Remove table and files with ``drop_table`` when done.
    """
    spark = df.sparkSession
    name = f"hazardlake_{label}_{uuid.uuid4().hex[:12]}"
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    # One writer task per bucket -> one file per bucket.
    (df.repartition(buckets, *cols).write.bucketBy(buckets, *cols).mode("overwrite")
     .option("path", path).saveAsTable(name))
    return spark.table(name), name


def drop_table(spark, name: str) -> None:
    """Drop a table of ``bucketed_copy`` and delete its files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    delete_path(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")


def staged_copy(df: DataFrame, label: str):
    """Write ``df`` once as files under the shared checkpoint folder and return (DataFrame that reads them, path).

    Like ``checkpoint``, but later reads take only the columns they need. Remove with ``delete_path`` when done.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hazardlake_{label}_{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark, path: str) -> None:
    """Delete files of a table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def joined_in_place(spark):
    """Inside, a join on (a, b) may keep a side where it lies bucketed by (a); the setting is put back afterwards."""
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's shared ``spark.checkpoint.dir``.

    Used to cut lineage in iterative jobs; lost executors recompute from the
    checkpoint files, not from the start of the iteration.
    """
    return df.checkpoint(eager=True)
