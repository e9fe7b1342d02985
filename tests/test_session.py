"""The shared folder, and when small inputs are spread."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newslake import session


class FakeConf(dict):
    def set(self, key, value):
        self[key] = value


class FakeSpark:
    def __init__(self, master, **conf):
        self.conf = FakeConf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_shared_folder_comes_from_the_session():
    spark = FakeSpark("spark://host:7077", spark_checkpoint_dir="s3a://bucket/check/")
    assert session.shared_root(spark) == "s3a://bucket/check"
    assert session.scratch_path(spark, "x").startswith("s3a://bucket/check/newslake/app/x-")


def test_a_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(FakeSpark("spark://host:7077"))


def test_a_local_session_makes_one_folder():
    spark = FakeSpark("local[2]")
    assert session.shared_root(spark) == session.shared_root(spark)


def test_setting_is_restored(spark):
    with session.setting(spark, "spark.sql.shuffle.partitions", "3"):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_settled_tables_have_a_known_size(spark):
    small = session.settle(spark.range(10).withColumn("x", F.lit(1)), "small")
    assert small.count() == 10
    big = session.settle(spark.range(1000), "big")
    plan = big.join(small, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_only_small_inputs_are_spread(spark, folder):
    path = folder("one-file")
    spark.range(100).coalesce(1).write.parquet(path)
    table = spark.read.parquet(path)
    assert session.spread(table, "id").rdd.getNumPartitions() == 4
    endless = spark.createDataFrame([(1,)], "id long")
    assert "REPARTITION" not in session.spread(endless, "id")._jdf.queryExecution().toString()


def test_large_frames_get_more_ranges(spark, folder, monkeypatch):
    path = folder("ranges")
    spark.range(10_000).write.parquet(path)
    monkeypatch.setattr(session, "RANGE_BYTES", 1000)
    ranged = session.in_ranges(spark.read.parquet(path), "id")
    assert ranged.rdd.getNumPartitions() > 8


def test_released_tables_go_at_the_end(spark):
    with session.released(spark) as outer:
        with session.released(spark) as tables:
            session.settle(spark.range(3), "gone")
            kept = session.settle(spark.range(5), "kept")
            path = tables.pop()
            gone = tables[0]
        assert kept.count() == 5 and not Path(gone).exists()
        assert outer == [gone, path]
    assert not Path(path).exists()
    settled = session.settle(spark.range(2), "after")
    assert settled.count() == 2
