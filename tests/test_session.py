import pytest

from tidemark.session import fresh_folder, shared_folder


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert fresh_folder(spark, "x").startswith(named + "/x-") and fresh_folder(spark, "x") != fresh_folder(spark, "x")


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    def __init__(self, master):
        self.master = master

    def getConf(self):
        return Conf()


class Session:
    conf = Conf()

    def __init__(self, master):
        self.sparkContext = Context(master)


def test_a_cluster_must_name_one():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn"))
    local = Session("local[2]")
    assert shared_folder(local) == shared_folder(local)
