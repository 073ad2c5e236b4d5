from types import SimpleNamespace

import pytest

from millrace.session import materialize, shared_dir


def session(master, folder=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf={"spark.checkpoint.dir": folder}, sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_materialized_rows_lie_in_the_shared_folder(spark):
    stored = materialize(spark.range(3), "three")
    assert stored.count() == 3
    assert all(shared_dir(spark) in path for path in stored.inputFiles())
