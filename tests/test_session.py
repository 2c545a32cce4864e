"""Session helpers: partition sizing, spreading small scans, bounded broadcast."""

from tidemark.session import bounded_broadcast, cluster_settings, spread


def test_cluster_settings_scale_with_shuffle_size():
    small = cluster_settings(10 << 30)
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = cluster_settings(100 << 40)
    assert big["spark.sql.shuffle.partitions"] == "100000"  # capped
    mid = cluster_settings(1 << 40)
    assert mid["spark.sql.shuffle.partitions"] == "4096"
    assert mid["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(256 << 20)


def test_spread_only_under_partitioned_frames(spark):
    cores = spark.sparkContext.defaultParallelism
    one = spark.range(1000).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == cores
    many = spark.range(1000).repartition(cores * 2)
    assert spread(many) is many


def test_bounded_broadcast_checks_the_bound(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert bounded_broadcast(big, 100) is big
    plan = big.join(bounded_broadcast(small, 100), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
