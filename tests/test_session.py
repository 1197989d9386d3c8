import pytest

from mercato import session
from mercato.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_existing_folder_is_kept():
    s = _Session(_Context("spark://cluster:7077", {}, current="hdfs:///ckpt/app"))
    assert ensure_checkpoint_dir(s) == "hdfs:///ckpt/app"


def test_cluster_setting_is_used():
    s = _Session(_Context("yarn", {"spark.checkpoint.dir": "s3a://bucket/ckpt"}))
    assert ensure_checkpoint_dir(s) == "s3a://bucket/ckpt"


def test_cluster_without_setting_fails_instead_of_using_a_local_folder():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(_Context("yarn", {})))


def test_local_mode_gets_a_temporary_folder():
    folder = ensure_checkpoint_dir(_Session(_Context("local[4]", {})))
    assert "mercato-ckpt-" in folder


def test_tasks_are_bounded_by_bytes(spark):
    """Few shuffle partitions are no reason for large tasks; what a session says itself stays."""
    keys = ("spark.sql.shuffle.partitions", *session.TASK_SIZE)
    was = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in session.TASK_SIZE:
            spark.conf.unset(k)
        spark.conf.set("spark.sql.shuffle.partitions", "2")
        session.tune(spark)
        keys_of = spark.range(3_000_000).selectExpr("xxhash64(id) AS k")
        assert keys_of.groupBy("k").count().rdd.getNumPartitions() > 2
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "3m")
        session.tune(spark)
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "3m"
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
