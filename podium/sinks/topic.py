"""Message topics as sinks: one JSON message per row, keyed by the group columns."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.config import TopicConfig
from podium.functions.messages import message
from podium.session import move_into_place, path_exists
from podium.sinks.files import MESSAGE_FILES


def to_records(df: DataFrame, key_columns: Sequence[str] = ()) -> DataFrame:
    key = message(*key_columns) if key_columns else F.lit(None).cast("string")
    return df.select(key.alias("key"), message().alias("value"))


def write_topic(
    df: DataFrame, topic: TopicConfig, key_columns: Sequence[str] = (), load_id: str | None = None
) -> None:
    """Publish every row, without a shuffle.

    A file-backed topic keeps each load in its own folder. A load becomes visible when it is complete, and is
    final then: loading the same id again adds nothing, so streams that have read it never meet it twice.
    Without an id rows are appended. Kafka may see a replayed load twice: consumers tell by the message
    key and the stream and batch id in the message.
    """
    write_records(to_records(df, key_columns), topic, load_id)


def write_records(records: DataFrame, topic: TopicConfig, load_id: str | None = None) -> None:
    """Publish (key, value) records as they are, under the same rules."""
    if topic.format == "kafka":
        records.write.format("kafka").option("topic", topic.name).options(**topic.options).save()
        return
    if topic.format == "text":
        records = records.select(F.col("value").cast("string"))
    else:
        records = records.select(*(F.col(c).cast("binary") for c in ("key", "value")))
    options = {**(MESSAGE_FILES if topic.format == "parquet" else {}), **topic.options}
    if load_id is None:
        records.write.format(topic.format).mode("append").options(**options).save(topic.name)
    else:
        spark = records.sparkSession
        target = f"{topic.name}/load-{load_id}"
        if path_exists(spark, target):
            return
        # Readers skip names that begin with an underscore.
        hidden = f"{topic.name}/_loading-{load_id}-{uuid.uuid4().hex}"
        records.write.format(topic.format).options(**options).save(hidden)
        move_into_place(spark, hidden, target)
