"""Message topics as streams or batches of (key, value) records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from podium.config import TopicConfig
from podium.functions.messages import parse_messages
from podium.schemas import TOPIC_RECORD


def kafka_options(topic: TopicConfig, streaming: bool) -> dict[str, str]:
    found = {
        "subscribe": topic.name,
        "startingOffsets": topic.starting_offsets,
        "failOnDataLoss": str(not topic.tolerate_loss).lower(),
        **topic.options,
    }
    if streaming and topic.max_per_trigger:
        found["maxOffsetsPerTrigger"] = str(topic.max_per_trigger)
    return found


def file_options(topic: TopicConfig, streaming: bool) -> dict[str, str]:
    # Each load writes its own sub-folder, see podium.sinks.topic.
    found = {
        "recursiveFileLookup": "true",
        "ignoreMissingFiles": str(topic.tolerate_loss).lower(),
        **topic.options,
    }
    if streaming and topic.max_per_trigger:
        found["maxFilesPerTrigger"] = str(topic.max_per_trigger)
    return found


def _open(reader, topic: TopicConfig, streaming: bool) -> DataFrame:
    reader = reader.format(topic.format)
    if topic.format == "kafka":
        return reader.options(**kafka_options(topic, streaming)).load()
    if topic.format == "parquet":
        reader = reader.schema(TOPIC_RECORD)
    elif topic.format != "text":
        raise ValueError(f"unknown topic format: {topic.format}")
    return reader.options(**file_options(topic, streaming)).load(topic.name)


def stream_topic(spark: SparkSession, topic: TopicConfig) -> DataFrame:
    """Unbounded records from the earliest message on; the checkpoint decides after a restart."""
    return _open(spark.readStream, topic, streaming=True)


def read_topic(spark: SparkSession, topic: TopicConfig) -> DataFrame:
    """The records present now, as a batch."""
    return _open(spark.read, topic, streaming=False)


def stream_once(
    spark: SparkSession, topic: TopicConfig, schema: StructType, keys: Sequence[str], time_column: str, delay: str = "1 hour"
) -> DataFrame:
    """Rows of an output topic, each once, although a replayed batch may stand in the topic twice.

    Rows are the same when stream, batch and ``keys`` are. State holds a key per row until the watermark of
    ``time_column`` has passed it by ``delay``; a repetition must come within that time.
    """
    tags = [StructField("stream_id", LongType()), StructField("batch_id", LongType())]
    rows = parse_messages(stream_topic(spark, topic), StructType([*schema.fields, *tags]))
    return rows.withWatermark(time_column, delay).dropDuplicatesWithinWatermark([t.name for t in tags] + [*keys])
