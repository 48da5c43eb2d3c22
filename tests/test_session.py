"""The shared working folder."""

from types import SimpleNamespace

import pytest

from tillmetrics.session import new_work_dir, shared_dir


def session(master, configured=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: configured or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_configured_folder_is_used(spark):
    assert shared_dir(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_work_dir(spark, "x") != new_work_dir(spark, "x")


def test_only_local_mode_may_do_without(spark):
    assert shared_dir(session("local[4]"))
    with pytest.raises(ValueError):
        shared_dir(session("yarn"))
