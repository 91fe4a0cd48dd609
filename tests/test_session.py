"""Folders and settings."""

from types import SimpleNamespace

import pytest

from dwelltide.session import remove_folder, run_folder, settings, shared_folder


def fake(master, configured=None, folder=None):
    made = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: folder, setCheckpointDir=made.append
    )
    conf = SimpleNamespace(get=lambda key, default: configured)
    return SimpleNamespace(sparkContext=context, conf=conf, made=made)


def test_the_cluster_names_the_folder():
    assert shared_folder(fake("yarn", "hdfs://x/checkpoints/")) == "hdfs://x/checkpoints"
    assert shared_folder(fake("yarn", None, "hdfs://y")) == "hdfs://y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))


def test_a_local_session_without_one_gets_a_temporary_folder():
    session = fake("local[2]")
    assert [shared_folder(session)] == session.made


def test_runs_have_folders_of_their_own(spark):
    assert run_folder(spark, "x") != run_folder(spark, "x")


def test_settings_are_put_back(spark):
    key, other = "spark.sql.shuffle.partitions", "spark.sql.streaming.metricsEnabled"
    before = spark.conf.get(key), spark.conf.get(other)
    with pytest.raises(RuntimeError), settings(spark, {key: "3", other: "true"}):
        assert spark.conf.get(key) == "3"
        raise RuntimeError
    assert (spark.conf.get(key), spark.conf.get(other)) == before


def test_a_folder_is_removed(spark, tmp_path):
    folder = f"{tmp_path}/run"
    spark.range(3).write.parquet(folder)
    remove_folder(spark, folder)
    remove_folder(spark, folder)
    assert list(tmp_path.iterdir()) == []
