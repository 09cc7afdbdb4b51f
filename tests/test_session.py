"""The shared folder: named by the cluster, or the session's own in local mode only."""

import pytest

from gustline.session import shared_dir


class _Conf:
    def get(self, key, default=None):
        return default


class _Context:
    applicationId = "test-app"

    def __init__(self, master):
        self.master = master

    def getConf(self):
        return _Conf()


class _Session:
    def __init__(self, master):
        self.conf, self.sparkContext = _Conf(), _Context(master)


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"])
def test_clusters_must_name_a_shared_folder(master):
    with pytest.raises(ValueError):
        shared_dir(_Session(master))


def test_local_mode_makes_one_folder():
    assert shared_dir(_Session("local[2]")) == shared_dir(_Session("local[2]"))
