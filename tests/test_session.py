import pytest

from askloom.session import cut, scratch_path, shared_root


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class Session:
    def __init__(self, master, conf=None):
        self.sparkContext = Context(master)
        self.conf = {"spark.checkpoint.dir": conf} if conf else {}


def test_the_named_folder_is_used():
    session = Session("spark://host", "hdfs:///shared/")
    assert shared_root(session) == "hdfs:///shared"
    assert session.sparkContext.folder == "hdfs:///shared/"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session("yarn"))


def test_a_local_master_gets_one():
    session = Session("local[2]")
    assert shared_root(session) == shared_root(session) == session.sparkContext.folder


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cut_ends_the_lineage(spark):
    df = cut(spark.range(10).groupBy().count())
    assert "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
