"""Where intermediate data may lie."""

from types import SimpleNamespace

import pytest

from glossweave import session


def fake(master, named=None):
    sc = SimpleNamespace(
        master=master, getConf=lambda: SimpleNamespace(get=lambda k: named), setCheckpointDir=lambda p: None,
        _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))),
    )
    return SimpleNamespace(sparkContext=sc)


def test_a_cluster_names_its_shared_folder():
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(fake("spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_dir(fake("local-cluster[3,1,1024]"))
    assert session.shared_dir(fake("yarn", "hdfs:///shared/x")) == "hdfs:///shared/x"


def test_one_machine_may_do_without():
    assert session.shared_dir(fake("local[4]")).startswith("/")
