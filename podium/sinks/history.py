"""Feature history: one Parquet folder per micro-batch, final once it is complete."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from podium.operators.aggregates import latest_per_key
from podium.session import names_in, path_exists, read_if_present, remove
from podium.sinks.files import replace_table, table_versions, version_path

_STREAM_ID = StructType([StructField("stream_id", LongType())])


def stream_id(spark: SparkSession, checkpoint: str) -> int:
    """A number that tells this checkpoint's stream from all others; made at its first start."""
    path = f"{checkpoint.rstrip('/')}-id"
    known = read_if_present(spark, path, _STREAM_ID)
    if known is None:
        spark.createDataFrame([(uuid.uuid4().int >> 65,)], _STREAM_ID).coalesce(1).write.parquet(path)
        known = spark.read.schema(_STREAM_ID).parquet(path)
    return known.first()["stream_id"]


def claim_history(spark: SparkSession, history: str, stream: int) -> None:
    """Make a new history this stream's; one that holds another stream's batches is refused.

    Batch ids of two checkpoints would meet, and rows be taken for replayed ones.
    """
    path = f"{history.rstrip('/')}-stream"
    owner = read_if_present(spark, path, _STREAM_ID)
    if owner is None:
        if path_exists(spark, history):
            raise ValueError(f"{history} holds batches of an unknown stream: name a new history")
        spark.createDataFrame([(stream,)], _STREAM_ID).coalesce(1).write.parquet(path)
    elif owner.first()["stream_id"] != stream:
        raise ValueError(f"{history} belongs to another checkpoint: name a new history")


def write_batch(batch: DataFrame, history: str, batch_id: int) -> None:
    """Store a micro-batch. A replay of one that is complete is computed but changes nothing."""
    path = f"{history}/batch_id={batch_id}"
    if path_exists(batch.sparkSession, f"{path}/_SUCCESS"):
        batch.write.format("noop").mode("overwrite").save()
    else:
        batch.write.mode("overwrite").parquet(path)


def with_batch_id(batch: DataFrame, batch_id: int, stream: int) -> DataFrame:
    return batch.withColumns(
        {"stream_id": F.lit(stream).cast("long"), "batch_id": F.lit(batch_id).cast("long")}
    )


def read_batch(spark: SparkSession, history: str, batch_id: int) -> DataFrame:
    return spark.read.parquet(f"{history}/batch_id={batch_id}")


def read_history(spark: SparkSession, history: str, schema: StructType) -> DataFrame:
    """All batches with their ``batch_id``; an error before the first one."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch_id", LongType())])).parquet(history)


def _with_batch(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("batch_id", LongType())])


def finished_batches(spark: SparkSession, history: str) -> list[int]:
    """Ids of the batches that are whole, ascending."""
    ids = (int(name.removeprefix("batch_id=")) for name in names_in(spark, history) if name.startswith("batch_id="))
    return sorted(i for i in ids if path_exists(spark, f"{history}/batch_id={i}/_SUCCESS"))


def _snapshots(history: str) -> str:
    return f"{history.rstrip('/')}-snapshots"


def read_latest(spark: SparkSession, history: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The newest row of each key group, from the last snapshot and the batches after it only."""
    known = table_versions(spark, _snapshots(history))
    since = known[-1] if known else -1
    paths = [f"{history}/batch_id={i}" for i in finished_batches(spark, history) if i > since]
    whole = _with_batch(schema)
    rows = spark.createDataFrame([], whole)
    if known:
        rows = spark.read.schema(whole).parquet(version_path(_snapshots(history), since))
    if paths:
        rows = rows.unionByName(spark.read.option("basePath", history).schema(whole).parquet(*paths))
    return latest_per_key(rows, keys)


def compact_history(
    spark: SparkSession, history: str, schema: StructType, keys: Sequence[str], drop: bool = False
) -> int | None:
    """Store the newest row of each key group as of the last whole batch, whose id is returned.

    The snapshot is a version of a table, numbered by that batch, and appears by one rename: a crash before leaves readers
    with the snapshot before and all batches after it. It is made from those, so its cost does not grow with the history. ``drop`` then
    deletes the batches before the last one, which are never replayed; ``read_history`` no longer shows them.
    """
    finished = finished_batches(spark, history)
    if not finished:
        return None
    last = finished[-1]
    columns = [f.name for f in _with_batch(schema).fields]
    replace_table(read_latest(spark, history, schema, keys).select(*columns), _snapshots(history), version=last)
    if drop:
        for i in finished[:-1]:
            remove(spark, f"{history}/batch_id={i}")
    return last
