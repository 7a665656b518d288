"""Session helpers."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from podium.session import is_local, settings, utc, work_folder


def fake(master: str, folder: str | None = None):
    conf = {} if folder is None else {"spark.checkpoint.dir": folder}
    context = SimpleNamespace(master=master, applicationId="app")
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_work_folder_is_new_and_shared(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = work_folder(spark, "x"), work_folder(spark, "x")
    assert one.startswith(root) and one != two


def test_cluster_needs_a_shared_folder():
    assert work_folder(fake("yarn", "hdfs:///work/"), "x").startswith("hdfs:///work/podium-x-")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            work_folder(fake(master), "x")


def test_local_session_may_use_a_temporary_folder():
    one, two = (work_folder(fake("local[2]"), "x") for _ in range(2))
    assert one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]


def test_is_local():
    assert is_local(fake("local")) and is_local(fake("local[*]"))
    assert not is_local(fake("local-cluster[2,1,1024]"))


def test_utc_keeps_settings(spark):
    assert utc(spark) is spark
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.shuffle.partitions", "3")
    sibling = utc(other)
    assert sibling.conf.get("spark.sql.session.timeZone") == "UTC"
    assert sibling.conf.get("spark.sql.shuffle.partitions") == "3"
    assert sibling.conf.get("spark.checkpoint.dir") == spark.conf.get("spark.checkpoint.dir")
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"


def test_settings_are_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(RuntimeError), settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
