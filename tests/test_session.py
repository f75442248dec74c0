"""Where scratch data goes."""

import pytest

from lendlayer.session import checkpoint_root, on_one_machine


class Fake:
    """As much of a session as the folder's choice looks at."""

    def __init__(self, master, warehouse, named=None):
        self.sparkContext = self.conf = self
        self.master, self.warehouse, self.root, self.named = master, warehouse, None, named

    def getCheckpointDir(self):
        return self.root

    def setCheckpointDir(self, path):
        self.root = path

    def getConf(self):
        named = self.named
        return type("Conf", (), {"get": lambda self, key, default=None: named or default})()

    def get(self, key):
        return self.warehouse


def test_the_named_folder_wins():
    assert checkpoint_root(Fake("yarn", "file:/w", "hdfs://x/ck/")) == "hdfs://x/ck"


def test_a_shared_warehouse_serves_otherwise():
    assert checkpoint_root(Fake("yarn", "hdfs://x/w/")) == "hdfs://x/w/_checkpoints"
    assert checkpoint_root(Fake("local[4]", "file:/w")) == "file:/w/_checkpoints"
    assert on_one_machine("local") and not on_one_machine("spark://host:7077") and not on_one_machine("k8s://x")


@pytest.mark.parametrize("warehouse", ["file:/w", "/w"])
def test_a_local_warehouse_on_a_cluster_is_an_error(warehouse):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Fake("spark://host:7077", warehouse))
