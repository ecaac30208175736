import pytest

from ratelake import session


class _FakeConf:
    def get(self, key, default=None):
        return default


class _FakeContext:
    def __init__(self, master="local[2]"):
        self.dir = None
        self.master = master

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = "file:" + d + "/uuid"


class _FakeSession:
    def __init__(self, master="local[2]"):
        self.conf = _FakeConf()
        self.sparkContext = _FakeContext(master)


def test_checkpoint_root_prefers_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert session.checkpoint_root(spark) == configured.rstrip("/")
    assert session.scratch_path(spark, "x").startswith(configured.rstrip("/") + "/ratelake-scratch/x-")


def test_checkpoint_root_sets_local_folder_only_when_unset():
    fake = _FakeSession()
    root = session.checkpoint_root(fake)
    assert root.startswith("file:") and root.endswith("/uuid")
    # later calls reuse the folder that was set
    assert session.checkpoint_root(fake) == root


def test_cluster_without_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.checkpoint_root(_FakeSession(master))


def test_scratch_is_removed(spark):
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    session.remove_scratch(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        session.remove_scratch(spark, "/somewhere/else")
