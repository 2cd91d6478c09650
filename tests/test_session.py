"""Checkpoint folder rule: the cluster's setting, a scratch folder only for local masters."""

import pytest

from presslake.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})


def test_cluster_setting_is_used():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"


def test_cluster_without_setting_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session("yarn"))


def test_local_master_gets_a_scratch_folder(tmp_path, monkeypatch):
    monkeypatch.setenv("TMPDIR", str(tmp_path))
    d = ensure_checkpoint_dir(_Session("local[4]"))
    assert d.startswith(str(tmp_path))
