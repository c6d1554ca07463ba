from pyspark.sql import functions as F

from hazardlake.operators.common import rank_within_groups, spread


def test_spread_only_when_too_few_partitions(spark):
    target = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=target * 2)
    assert spread(many) is many                                  # no extra shuffle at scale
    few = spark.range(0, 1000, numPartitions=1)
    assert spread(few).rdd.getNumPartitions() == target


def test_rank_within_groups_keeps_null_groups(spark):
    df = spark.createDataFrame([(None, 2), ("a", 1), (None, 1)], "g string, v int")
    got = {(r.g, r.v): r._pos for r in rank_within_groups(df, ["g"], [F.asc("v")]).collect()}
    assert got == {(None, 1): 1, (None, 2): 2, ("a", 1): 1}
