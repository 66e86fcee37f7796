from types import SimpleNamespace

import pytest

from regua.session import scratch_path, scratch_root


def fake(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: folder or default)
    context = SimpleNamespace(master=master, applicationId=f"app-{master}")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(fake("yarn", "hdfs://name/ck/")) == "hdfs://name/ck"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(fake("spark://host:7077"))


def test_local_master_gets_one_folder_of_its_own():
    local = fake("local[2]")
    assert scratch_root(local) == scratch_root(local)


def test_paths_are_never_reused():
    session = fake("yarn", "s3://bucket/ck")
    first, second = scratch_path(session, "t"), scratch_path(session, "t")
    assert first != second and first.startswith("s3://bucket/ck/regua/") and first.endswith("/t")
