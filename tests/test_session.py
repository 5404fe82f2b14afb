"""Scratch folder resolution: the session's spark.checkpoint.dir, which only a local master may leave unset."""

import os

import pytest

from lakeload.session import checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _NoContext:
    def __init__(self, value):
        self.conf = _Conf(value)

    @property
    def sparkContext(self):  # noqa: N802 - mirrors the session attribute
        raise RuntimeError("no context")


def test_configured_folder_is_used(spark):
    assert checkpoint_dir(_NoContext("hdfs://nn/ckpt")) == "hdfs://nn/ckpt"
    p = scratch_path(_NoContext("hdfs://nn/ckpt/"), "stage")
    assert p.startswith("hdfs://nn/ckpt/lakeload/stage-")


def test_unset_is_refused_unless_the_master_is_local():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(_NoContext(None))


def test_local_master_may_leave_it_unset():
    class Local:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return "local[2]" if key == "spark.master" else default

        class sparkContext:  # noqa: N801
            applicationId = "local-test-session"

            @staticmethod
            def getCheckpointDir():
                return None

            @staticmethod
            def setCheckpointDir(path):
                pass

    first = checkpoint_dir(Local)
    assert os.path.isdir(first) and checkpoint_dir(Local) == first
