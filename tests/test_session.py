"""The shared folder rule: no machine-local scratch folder off local masters."""

import pytest

from civic_spark import session


class _Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class _Conf:
    def get(self, key, default=None):
        return default


class _Session:
    def __init__(self, master):
        self.sparkContext, self.conf = _Context(master), _Conf()


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(_Session(master))


def test_local_masters():
    assert session.is_local_master("local") and session.is_local_master("local[4]")
    assert not session.is_local_master("local-cluster[2,1,1024]")
