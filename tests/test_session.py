"""Scratch space follows spark.checkpoint.dir; a local folder only when it is unset."""

from __future__ import annotations

import pytest

from chatlake.session import checkpoint_root, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default

    def set(self, key, value):  # the real session refuses this core setting
        raise AssertionError("spark.checkpoint.dir cannot be set at run time")


class _Context:
    def __init__(self):
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, value):
        self.conf = _Conf(value)
        self.sparkContext = _Context()


def test_uses_the_configured_shared_folder():
    s = _Session("hdfs://cluster/shared/ckpt/")
    assert checkpoint_root(s) == "hdfs://cluster/shared/ckpt"
    assert scratch_path(s, "x").startswith("hdfs://cluster/shared/ckpt/chatlake/x-")
    assert s.sparkContext.dir is None


def test_unset_is_an_error_off_local_masters():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        s = _Session(None)
        s.sparkContext.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(s)


def test_unset_registers_a_local_folder_once():
    s = _Session(None)
    s.sparkContext.master = "local[2]"
    first = checkpoint_root(s)
    assert s.sparkContext.dir == first
    assert checkpoint_root(s) == first


def test_real_session_root(spark):
    assert checkpoint_root(spark)
