from types import SimpleNamespace

import pytest

from strandloom import shared


def session(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master, applicationId=f"app of {master}"))


def test_a_cluster_needs_the_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.shared_dir(session(master))
        assert shared.shared_dir(session(master, "hdfs://name/folder/")) == "hdfs://name/folder"


def test_a_local_session_may_do_without():
    for master in ("local", "local[4]", "local[*]", "local[4,2]"):
        assert shared.shared_dir(session(master)).startswith("file:///")
