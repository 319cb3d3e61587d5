"""The shared folder, with and without the cluster's setting."""

from __future__ import annotations

import os

import pytest

from chronosift import storage


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    """As much of a session as the folder needs."""

    def __init__(self, master, conf=()):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}", "getConf": lambda _: Conf(conf)})()


def test_the_clusters_folder_is_taken():
    find = storage.shared_folder
    assert find(Session("spark://host:7077", {"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_only_a_local_master_goes_without():
    find = storage.shared_folder
    for master in ("local", "local[4]"):
        session = Session(master)
        assert os.path.isdir(find(session)) and find(session) == find(session)
    for master in ("local-cluster[2,1,1024]", "yarn"):
        with pytest.raises(ValueError, match="executors share"):
            find(Session(master))


def test_durable_rows_are_computed_once(spark):
    from pyspark.sql import functions as F

    df = storage.durable(spark.range(100).select("id", F.rand().alias("x")))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, df.collect()))
