"""The shared folder: read from the session, created privately only when unset."""

from __future__ import annotations

import os

from regiontally.session import checkpoint_root, shared_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    master = "local[2]"

    def __init__(self, conf, current=None):
        self._conf, self.current, self.installed = _Conf(conf), current, None

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.installed = path
        self.current = f"{path}/app-subfolder"


class _Session:
    def __init__(self, conf=None, current=None):
        self.sparkContext = _Context(conf or {}, current)


def test_configured_folder_is_used():
    session = _Session({"spark.checkpoint.dir": "hdfs:///shared/ckpt/"})
    assert checkpoint_root(session) == "hdfs:///shared/ckpt"
    assert session.sparkContext.installed is None
    assert shared_dir(session, "log", unique=False) == "hdfs:///shared/ckpt/regiontally/log"


def test_folder_set_on_the_context_is_used():
    session = _Session(current="hdfs:///shared/ckpt/1234-app")
    assert checkpoint_root(session) == "hdfs:///shared/ckpt"


def test_private_folder_only_when_unset():
    session = _Session()
    root = checkpoint_root(session)
    assert os.path.isdir(root) and session.sparkContext.installed == root
    a, b = shared_dir(session, "x"), shared_dir(session, "x")
    assert a != b and a.startswith(f"{root}/regiontally/x/")
