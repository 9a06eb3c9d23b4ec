"""Choice of the folder for staged results."""

from types import SimpleNamespace

import pytest

from basketry.operators import staging


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, shared=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: shared), sparkContext=Context(master))


def test_named_folder_is_used():
    assert staging.staging_root(session("spark://host:1", "/shared")) == "/shared"


def test_local_master_may_use_a_temporary_folder():
    local = session("local[2]")
    assert staging.staging_root(local) == local.sparkContext.folder == staging.staging_root(local)


def test_cluster_without_a_folder_stops():
    with pytest.raises(ValueError):
        staging.staging_root(session("spark://host:1"))


def test_stage_keeps_rows(spark):
    assert staging.stage(spark.range(5)).count() == 5
