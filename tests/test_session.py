from __future__ import annotations

import pytest

from tradewind import shared_folder, workspace
from tradewind.session import several_tasks_a_core, side_by_side, small_sides_hashed


class FakeContext:
    def __init__(self, master, conf=None):
        self.master, self.conf, self.dir = master, conf or {}, None

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


class FakeSession:
    def __init__(self, master, conf=None):
        self.sparkContext = FakeContext(master, conf)
        self.conf = conf or {}


def test_shared_folder_is_the_named_one():
    session = FakeSession("spark://master:7077", {"spark.checkpoint.dir": "hdfs:///shared/"})
    assert shared_folder(session) == "hdfs:///shared"
    assert workspace(session, "x").startswith("hdfs:///shared/tradewind/x-")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match=r"spark\.checkpoint\.dir"):
        shared_folder(FakeSession("yarn"))


def test_workspaces_differ(spark):
    assert workspace(spark, "x") != workspace(spark, "x")


def test_settings_are_put_back(spark):
    keys = ["spark.sql.files.minPartitionNum", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"]
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(RuntimeError, match="inside"), several_tasks_a_core(spark), small_sides_hashed(spark):
        assert spark.conf.get(keys[0]) == str(4 * spark.sparkContext.defaultParallelism) and spark.conf.get(keys[1]) == "64m"
        raise RuntimeError("inside")
    assert [spark.conf.get(k, None) for k in keys] == before


def test_side_by_side_ends_all_and_raises():
    done = []

    def fail():
        raise ValueError("one")

    with pytest.raises(ValueError, match="one"):
        side_by_side(fail, lambda: done.append(1), lambda: done.append(2))
    assert sorted(done) == [1, 2]
