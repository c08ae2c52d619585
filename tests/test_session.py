import os

import pytest

from pulselake.session import remove_path, shared_dir


class Session:
    """A stand-in for a session on a cluster."""

    def __init__(self, master, folder=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder or default)})()


def test_scratch_lies_in_the_folder_the_cluster_names():
    first = shared_dir(Session("yarn", "hdfs://lake/checkpoints/"), "x")
    assert first.startswith("hdfs://lake/checkpoints/pulselake/x-")
    assert first != shared_dir(Session("yarn", "hdfs://lake/checkpoints/"), "x")


def test_no_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"), "x")
    assert shared_dir(Session("local[4]"), "x").startswith("/")


def test_remove_path(spark, path):
    spark.range(1).write.parquet(path + "/t")
    remove_path(spark, path + "/t")
    assert not os.path.exists(path + "/t")
    remove_path(spark, path + "/t")
