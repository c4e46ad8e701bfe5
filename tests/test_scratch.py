"""Where queries may write."""

import os
from types import SimpleNamespace

import pytest

from workload.scratch import new_database, new_folder, scratch_root


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key, default: settings.get(key.replace(".", "_"), default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_shared_folder_of_the_session_is_used():
    shared = session("yarn", spark_checkpoint_dir="hdfs://cluster/shared/")
    assert scratch_root(shared) == "hdfs://cluster/shared"


def test_folders_are_new_and_go_with_the_application(spark):
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_a_local_folder_only_with_a_local_master():
    assert os.path.isdir(scratch_root(session("local[2]")))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("spark://cluster:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("local-cluster[3,2,1024]"))


def test_databases_are_fresh_and_in_the_shared_folder(spark):
    name, folder = new_database(spark, "fresh")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert spark.catalog.databaseExists(name) and not spark.catalog.listTables(name)
