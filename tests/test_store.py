from __future__ import annotations

import os

import pytest

from gridcast import store


class Unconfigured:
    """A session without the setting, as far as ``shared_dir`` looks at one."""

    def __init__(self, master, folder=None):
        self.conf, self.sparkContext = self, self
        self.master, self.folder = master, folder

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_dir_is_the_sessions(spark):
    assert store.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_local_session_gets_a_folder_of_its_own(tmp_path, monkeypatch):
    monkeypatch.setattr(store.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    fresh = Unconfigured("local[4]")
    assert store.shared_dir(fresh) == fresh.folder == store.shared_dir(fresh)
    assert store.shared_dir(Unconfigured("yarn", "hdfs:///shared")) == "hdfs:///shared"


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://host", "local-cluster[2,1,512]"])
def test_other_sessions_need_the_setting(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_dir(Unconfigured(master))


def test_scratch_removes_what_was_landed_inside_it(spark):
    with store.scratch(spark) as folder:
        df, path = store.put(spark.range(3), "t")
        assert path.startswith(folder) and df.count() == 3
        with store.scratch(spark) as inner:
            assert store.put(spark.range(1), "u")[1].startswith(inner)
        assert os.path.exists(path) and not os.path.exists(inner)
    assert not os.path.exists(folder)


def test_scratch_cleans_up_after_an_error(spark):
    with pytest.raises(RuntimeError):
        with store.scratch(spark) as folder:
            store.land(spark.range(3), "t")
            raise RuntimeError
    assert not os.path.exists(folder)
