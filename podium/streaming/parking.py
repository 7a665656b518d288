"""Messages that come before their dimension row: parked, retried when the dimension is refreshed, expired.

A gate stands before the feature stream. Each micro-batch of messages, and each refreshed dimension, makes a new version of
what waits: messages whose key is in the dimension become ``ready``, others stay ``parked`` until their event time is
``timeout`` behind the newest one, and are ``expired`` then. Ready messages are published, byte for byte, to the topic
that the feature stream reads, so that its running state needs no change.

A version is a folder, named by its number, its origin and the newest event time, that becomes visible by one rename and is final
then. A replayed micro-batch finds its version and changes nothing; publishing a version again adds nothing either, so a
crash between the steps neither loses a message nor counts one twice. A version reads the one before it only;
ready and expired messages stay where they were decided, and can be counted or taken up by hand.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from podium.config import ParkingConfig, SizingConfig, StreamConfig
from podium.functions.messages import parse_messages
from podium.operators.joins import enrich
from podium.schemas import TOPIC_RECORD
from podium.session import mark, move_into_place, names_in, path_exists
from podium.sinks.fanout import Sink
from podium.sinks.files import MESSAGE_FILES
from podium.sinks.history import stream_id
from podium.sinks.topic import write_records
from podium.sources.topic import stream_topic
from podium.streaming.features import Dimension, await_all, prepare_dimension, run_feature_stream, start

STATUSES = ("ready", "parked", "expired")

VERSION = StructType(
    [
        *TOPIC_RECORD.fields,
        StructField("seen_at", TimestampType()),
        StructField("status", StringType()),
        StructField("version", LongType()),
    ]
)


@dataclass(frozen=True)
class Version:
    number: int
    origin: str
    newest: int  # event time in microseconds, 0 before the first message with a time

    @property
    def name(self) -> str:
        return f"{self.number:012d}~{self.origin}~{self.newest}"

    @staticmethod
    def of(name: str) -> Version:
        number, origin, newest = name.split("~")
        return Version(int(number), origin, int(newest))


def versions(spark: SparkSession, parking: ParkingConfig) -> list[Version]:
    return [Version.of(name) for name in names_in(spark, parking.folder)]


def _read(spark: SparkSession, parking: ParkingConfig, version: Version) -> DataFrame:
    return spark.read.schema(VERSION).parquet(f"{parking.folder}/{version.name}")


def decided(spark: SparkSession, parking: ParkingConfig) -> DataFrame:
    """Every message once, with its status: ready and expired ones of all versions, and those parked in the last one."""
    known = versions(spark, parking)
    if not known:
        return spark.createDataFrame([], VERSION)
    rows = spark.read.schema(VERSION).parquet(*(f"{parking.folder}/{v.name}" for v in known))
    return rows.where((F.col("status") != "parked") | (F.col("version") == known[-1].number))


class Gate:
    """Makes versions for one checkpoint; ``keys`` are the distinct keys of the dimension of this round."""

    def __init__(
        self, spark: SparkSession, parking: ParkingConfig, key: StructField, keys: DataFrame, owner: int, sizing: SizingConfig
    ):
        self.spark, self.parking, self.key, self.keys, self.owner, self.sizing = spark, parking, key, keys, owner, sizing

    def publish(self, version: Version) -> None:
        """Ready messages of a version as one load, unless that was done before."""
        done = f"{self.parking.folder}/_published-{version.number}"
        if path_exists(self.spark, done):
            return
        ready = _read(self.spark, self.parking, version).where("status = 'ready'").select("key", "value")
        write_records(ready, self.parking.ready, load_id=f"{self.owner}-{version.number}")
        mark(self.spark, done)

    def advance(self, origin: str, messages: DataFrame | None = None) -> Version:
        """The version that these messages, or a refreshed dimension, lead to."""
        known = versions(self.spark, self.parking)
        for version in known:
            if version.origin == origin:
                self.publish(version)
                return version
        last = known[-1] if known else Version(-1, "", 0)
        columns = ["key", "value", "seen_at"]
        waiting = None
        if known:
            self.publish(last)
            waiting = _read(self.spark, self.parking, last).where("status = 'parked'").select(*columns)
        newest = last.newest
        if messages is not None:
            fields = StructType([StructField(self.parking.event_time, TimestampType())])
            timed = parse_messages(messages, fields, keep=["key", "value"]).toDF(*columns)
            newest = max(newest, timed.agg(F.unix_micros(F.max("seen_at"))).first()[0] or 0)
            # A message without a time waits from the newest one on.
            timed = timed.withColumn("seen_at", F.coalesce("seen_at", F.timestamp_micros(F.lit(newest))))
            waiting = timed if waiting is None else waiting.unionByName(timed)
        version = Version(last.number + 1, origin, newest)
        if waiting is None:
            waiting = self.spark.createDataFrame([], VERSION).select(*columns)
        keyed = parse_messages(waiting, StructType([self.key]), keep=columns).toDF(*columns, "__key")
        keys = self.keys.toDF("__key").withColumn("__met", F.lit(True))
        met = enrich(keyed, keys, "__key", how="left", sizing=self.sizing)
        late = F.col("seen_at") < F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {self.parking.timeout}")
        # Messages without a key can wait for nothing: the stream deals with them.
        status = F.when(F.col("__key").isNull() | F.col("__met"), "ready").when(late, "expired").otherwise("parked")
        rows = met.select(*columns, status.alias("status"), F.lit(version.number).cast("long").alias("version"))
        hidden = f"{self.parking.folder}/_making-{uuid.uuid4().hex}"
        rows.write.options(**MESSAGE_FILES).parquet(hidden)
        move_into_place(self.spark, hidden, f"{self.parking.folder}/{version.name}")
        self.publish(version)
        return version


def run_gate(
    spark: SparkSession, stream: StreamConfig, parking: ParkingConfig, dimension: Dimension, schema: StructType
) -> None:
    """Retry what is parked with this dimension, then take the messages that are waiting."""
    key = schema[stream.features.key]
    owner = stream_id(spark, f"{stream.checkpoint}/gate")
    gate = Gate(spark, parking, key, dimension.rows.select(key.name).distinct(), owner, stream.sizing)
    # The topic must be there before the feature stream opens it.
    write_records(spark.createDataFrame([], TOPIC_RECORD), parking.ready, load_id=f"{owner}-begin")
    known = versions(spark, parking)
    if known:
        gate.advance(f"refresh-{known[-1].number + 1}")

    def take(batch: DataFrame, batch_id: int) -> None:
        if "key" not in batch.columns:
            batch = batch.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
        gate.advance(f"batch-{batch_id}", batch.select("key", "value"))

    writer = stream_topic(spark, stream.topic).writeStream.foreachBatch(take)
    await_all([start(writer, f"{stream.checkpoint}/gate")])


def run_parked_stream(
    spark: SparkSession,
    stream: StreamConfig,
    parking: ParkingConfig,
    dim: Callable[[], DataFrame],
    schema: StructType,
    sinks: dict[str, Sink] | None = None,
    rounds: int | None = None,
) -> None:
    """Like ``run_refreshed_stream``, but messages wait for their dimension row until the timeout.

    Each round takes the dimension anew, retries the parked messages, takes the new ones, and runs the feature
    stream over those that are ready.
    """
    bounded = replace(stream, trigger=None, snapshot_trigger=None)
    ready = replace(bounded, topic=parking.ready)
    done = 0
    while rounds is None or done < rounds:
        began = time.monotonic()
        dimension = prepare_dimension(spark, dim(), bounded, schema)
        run_gate(spark, bounded, parking, dimension, schema)
        run_feature_stream(spark, ready, dimension, schema, sinks)
        done += 1
        if rounds is None or done < rounds:
            time.sleep(max(0.0, (stream.refresh_seconds or 0.0) - (time.monotonic() - began)))
