"""Layer tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from podium.session import move_into_place, names_in, remove

# A task reads whole row groups, and a message costs a parse: with groups of the usual 128 MB, millions of messages would be one
# task's. Spark makes no split smaller than 4 MB.
MESSAGE_FILES = {"parquet.block.size": str(4 << 20)}


def overwrite_parquet(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; running a stage again gives the same table."""
    df.write.mode("overwrite").parquet(path)


_VERSION = "v"
_MAKING = "_making-"


def table_versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions of a versioned table, oldest first."""
    return sorted(int(name[len(_VERSION) :]) for name in names_in(spark, path) if name[len(_VERSION) :].isdigit())


def version_path(path: str, version: int) -> str:
    return f"{path}/{_VERSION}{version:012d}"


def replace_table(df: DataFrame, path: str, version: int | None = None, keep: int = 2) -> int:
    """Add a version to the table at ``path``, which readers see by one rename, whole or not at all.

    Until then, and when the write fails, they go on with the version before. The last ``keep`` versions stay, so that a
    reader that has begun on an older one can finish; what failed writes left goes with the next one. One writer at a time. A
    ``version`` that is there already is final.
    """
    spark = df.sparkSession
    known = table_versions(spark, path)
    if version is None:
        version = known[-1] + 1 if known else 0
    elif version in known:
        return version
    for name in names_in(spark, path, hidden=True):
        if name.startswith(_MAKING):
            remove(spark, f"{path}/{name}")
    making = f"{path}/{_MAKING}{uuid.uuid4().hex}"
    df.write.parquet(making)
    move_into_place(spark, making, version_path(path, version))
    for old in sorted([*known, version])[: -max(1, keep)]:
        remove(spark, version_path(path, old))
    return version
