"""Where scratch tables go: a cluster must name a shared folder."""

from types import SimpleNamespace

import pytest

from tributary.plans.scratch import scratch_folder


def session(master, shared=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared), sparkContext=SimpleNamespace(master=master)
    )


def test_shared_folder_is_used_where_named():
    assert scratch_folder(session("spark://host:7077", "file:///shared/"), "x").startswith("file:///shared/x-")


def test_local_session_gets_a_temporary_folder():
    assert scratch_folder(session("local[2]"), "x")


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_folder(session(master), "x")
