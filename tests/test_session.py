"""The shared folder comes from the session; a local one only when unset."""

from indicata.session import scratch_path, shared_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default


class _Context:
    def __init__(self, ckpt=None, master="local[2]"):
        self.ckpt = ckpt
        self.master = master
        self.set_calls = []

    def getCheckpointDir(self):
        return self.ckpt

    def setCheckpointDir(self, path):
        self.set_calls.append(path)
        self.ckpt = path + "/uuid"


class _Session:
    def __init__(self, conf_value, ckpt=None):
        self.conf = _Conf(conf_value)
        self.sparkContext = _Context(ckpt)


def test_uses_session_setting():
    s = _Session("hdfs://nn/shared/ckpt/", ckpt="hdfs://nn/shared/ckpt/abc")
    assert shared_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.set_calls == []
    assert scratch_path(s, "x").startswith("hdfs://nn/shared/ckpt/landing/x-")


def test_registers_context_folder_when_only_conf_is_set():
    s = _Session("s3a://bucket/ckpt")
    assert shared_dir(s) == "s3a://bucket/ckpt"
    assert s.sparkContext.set_calls == ["s3a://bucket/ckpt"]


def test_local_fallback_when_unset():
    s = _Session(None)
    base = shared_dir(s)
    assert base.startswith("/") and s.sparkContext.set_calls == [base]


def test_real_session_has_folder(spark):
    assert shared_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_no_local_fallback_on_a_cluster():
    import pytest

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        s = _Session(None)
        s.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_dir(s)
