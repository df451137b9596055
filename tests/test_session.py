from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tempoflow import session


class FakeContext:
    def __init__(self, master):
        self.master = master
        self.folder = None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def fake_session(master, configured=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured or default), sparkContext=FakeContext(master))


def test_shared_folder_is_read_from_the_session():
    cluster = fake_session("spark://host:7077", "hdfs://host/shared")
    assert session.shared_dir(cluster) == cluster.sparkContext.folder == "hdfs://host/shared"
    assert session.stage_path(cluster, "x").startswith("hdfs://host/shared/x-")


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake_session("spark://host:7077"))


def test_a_local_session_falls_back_to_one_temporary_folder():
    local = fake_session("local[8]")
    assert session.shared_dir(local) == session.shared_dir(local) == local.sparkContext.folder


def test_checkpoint_cuts_the_lineage(spark):
    frame = session.checkpointed(spark.range(100).where("id % 2 = 0"))
    assert frame.count() == 50
    assert "Range" not in frame._jdf.queryExecution().executedPlan().toString()


def test_spreading_changes_only_narrow_frames(spark):
    narrow, wide = spark.range(0, 10, 1, 1), spark.range(0, 100, 1, 64)
    assert session.spread_if_narrow(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert session.spread_if_narrow(wide) is wide
    assert session.splittable(wide.withColumn("k", F.col("id") % 3), "k").count() == 100
