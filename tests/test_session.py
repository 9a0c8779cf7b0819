import os
from types import SimpleNamespace

import pytest

from orelode import session


def fake(master, folder=None, application="app"):
    conf = SimpleNamespace(get=lambda name, default=None: folder or default)
    context = SimpleNamespace(master=master, applicationId=application)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_the_named_folder_is_used():
    assert session.shared_folder(fake("yarn", "hdfs://name/checkpoints/")) == (
        "hdfs://name/checkpoints"
    )
    assert session.application_folder(fake("yarn", "hdfs://name/c", "app-7")) == (
        "hdfs://name/c/orelode/app-7"
    )


def test_a_local_session_without_one_gets_its_own():
    first = session.shared_folder(fake("local[2]"))
    assert os.path.isdir(first)
    assert session.shared_folder(fake("local[2]")) == first


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("spark://master:7077"))


def test_settings_of_the_session_are_read(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
