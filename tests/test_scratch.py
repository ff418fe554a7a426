"""Stage folders: named once, removable, and gone after a block."""

import os

from cairn.session import CLUSTER_PROFILE, persisted, release_scratch, remove_path, scratch, scratch_path


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_scratch_folders_can_be_released(spark):
    release_scratch(spark)
    one, two = scratch_path(spark, "t-one"), scratch_path(spark, "t-two")
    spark.range(3).write.parquet(one)
    assert one != two and os.path.isdir(_local(one))
    assert release_scratch(spark) == 1 and not os.path.exists(_local(one))
    assert release_scratch(spark) == 0
    assert not remove_path(spark, one)


def test_a_scratch_block_removes_its_folder(spark):
    with scratch(spark, "t-block") as path:
        spark.range(5).write.parquet(path)
        assert spark.read.parquet(path).count() == 5
    assert not os.path.exists(_local(path))


def test_the_cluster_profile_cleans_checkpoints(spark):
    assert CLUSTER_PROFILE["spark.cleaner.referenceTracking.cleanCheckpoints"] == "true"
    assert spark.sparkContext.getConf().get("spark.cleaner.referenceTracking.cleanCheckpoints") == "true"


def test_persisted_serves_the_block_and_is_released(spark):
    frame = spark.range(100).selectExpr("id % 7 AS k")
    with persisted(frame) as kept:
        assert kept.count() == 100 and kept.storageLevel.useMemory
        plan = kept.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryTableScan" in plan
    assert not frame.storageLevel.useMemory
