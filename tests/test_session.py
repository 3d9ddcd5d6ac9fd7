"""Checkpoint-folder resolution: the cluster's setting wins; an unset one is set on the
SparkContext (a running session rejects ``conf.set`` of this core setting)."""
from sevscope.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" and self.value else default

    def set(self, key, value):  # pragma: no cover - must not be called
        raise AssertionError("spark.checkpoint.dir cannot be set on a running session")


class _SC:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, conf_value):
        self.conf = _Conf(conf_value)
        self.sparkContext = _SC()


def test_cluster_setting_is_used():
    s = _Session("hdfs://shared/ckpt")
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"
    assert s.sparkContext.dir == "hdfs://shared/ckpt"


def test_unset_folder_goes_to_the_context(monkeypatch, tmp_path):
    monkeypatch.setenv("SEVSCOPE_CHECKPOINT_DIR", str(tmp_path))
    s = _Session(None)
    assert ensure_checkpoint_dir(s) == str(tmp_path)
    assert s.sparkContext.dir == str(tmp_path)
    # later calls reuse the context's folder
    assert ensure_checkpoint_dir(s) == str(tmp_path)
