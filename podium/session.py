"""Session settings and shared working folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# ANSI mode stays at its default (on); tolerant parsing is explicit through try_cast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """The session itself when it runs in UTC, else a sibling session with its settings that does."""
    if spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "Z", "+00:00"):
        return spark
    sibling = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if sibling.conf.isModifiable(name):
            sibling.conf.set(name, value)
    sibling.conf.set("spark.sql.session.timeZone", "UTC")
    return sibling


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="podium-")


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session without that setting falls back to
    a temporary folder, since there driver and executors share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _own_folder(spark.sparkContext.applicationId)
    return f"{root.rstrip('/')}/podium-{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, files = _file_system(spark, path)
    return files.exists(target)


def names_in(spark: SparkSession, folder: str, hidden: bool = False) -> list[str]:
    """Names of the finished (or the hidden) entries of a folder, sorted; none where there is no folder."""
    target, files = _file_system(spark, folder)
    if not files.exists(target):
        return []
    names = (status.getPath().getName() for status in files.listStatus(target))
    return sorted(name for name in names if name.startswith(("_", ".")) == hidden)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the library made itself, if it is there."""
    target, files = _file_system(spark, path)
    files.delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file that says that something is done."""
    target, files = _file_system(spark, path)
    files.create(target, True).close()


def move_into_place(spark: SparkSession, source: str, target: str) -> None:
    """Rename a finished folder; readers see all of it or nothing."""
    path, files = _file_system(spark, source)
    place, _ = _file_system(spark, target)
    if not files.rename(path, place):
        raise OSError(f"cannot rename {source} to {target}")


def read_if_present(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A Parquet table, or None where there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Apply session settings for one statement, e.g. a query start, which copies them."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
