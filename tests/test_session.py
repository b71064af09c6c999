import pytest

from brisa import session


class _Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, master, **conf):
        self.sparkContext, self.conf = _Context(master), _Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_a_cluster_needs_a_shared_checkpoint_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session("spark://host:7077"))
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]"))
    assert session.ensure_checkpoint_dir(_Session("spark://host:7077", spark_checkpoint_dir="hdfs:///x")) == "hdfs:///x"


def test_a_local_master_gets_a_folder_of_its_own():
    s = _Session("local[4]")
    assert session.ensure_checkpoint_dir(s) == s.conf["spark.checkpoint.dir"]


def test_launcher_settings_hold_unless_given(monkeypatch):
    seen = {}

    class Builder:
        def appName(self, n):
            return self

        def master(self, m):
            seen["master"] = m
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            class S:
                sparkContext = type("C", (), {"setLogLevel": lambda self, x: None, "getCheckpointDir": lambda self: "/x"})()

            return S()

    monkeypatch.setattr(session, "SparkSession", type("T", (), {"builder": Builder()}))
    session.build_session()
    assert "master" not in seen and "spark.sql.shuffle.partitions" not in seen
    session.build_session("local[2]", 3)
    assert seen["master"] == "local[2]" and seen["spark.sql.shuffle.partitions"] == "3"
