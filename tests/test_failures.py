"""Lost tasks: what a first attempt did may not show in the result."""

from __future__ import annotations

import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from podium.config import FeatureConfig, JdbcConfig, SizingConfig, TopicConfig
from podium.operators import enrich, joined_averages
from podium.plans import clean_layer
from podium.sinks import append_batch, append_rows, read_history, write_batch, write_topic
from podium.sources import read_jdbc, read_topic

LARGE = SizingConfig(broadcast_bytes=-1)


@F.udf(LongType())
def failing_once(value):
    """Dies on the first attempt of a task, in the middle of its rows."""
    if value % 100 == 60 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("executor lost")
    return value


@pytest.fixture
def rows(spark):
    return spark.range(0, 1000, 1, 5).select(failing_once("id").alias("id"), (F.col("id") % 7).alias("k"))


def whole(rows):
    return rows.agg(F.count("id"), F.count_distinct("id"), F.sum("id")).first()[:] == (1000, 1000, 499500)


def test_database_rows_are_not_repeated(spark, rows, tmp_path):
    table = JdbcConfig(
        url=f"jdbc:derby:{tmp_path}/db;create=true", table="t" + uuid.uuid4().hex[:8],
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", batch_size=10,
    )
    append_rows(rows, table)
    assert whole(read_jdbc(spark, table))


def test_batch_in_a_database(spark, rows, tmp_path):
    table = JdbcConfig(
        url=f"jdbc:derby:{tmp_path}/db;create=true", table="batches",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", batch_size=10,
    )
    for _ in range(2):
        append_batch(rows, table, 0, ["id"])
    assert whole(read_jdbc(spark, table))


@pytest.mark.parametrize("kind", ["parquet", "text"])
def test_topic(spark, rows, tmp_path, kind):
    topic = TopicConfig(str(tmp_path), kind)
    write_topic(rows, topic, load_id="1")
    ids = read_topic(spark, topic).select(
        F.get_json_object(F.col("value").cast("string"), "$.id").cast("long").alias("id")
    )
    assert whole(ids)


def test_history(spark, rows, tmp_path):
    write_batch(rows, str(tmp_path), 0)
    assert whole(read_history(spark, str(tmp_path), rows.schema))


def test_distinct(rows):
    assert whole(clean_layer(rows.union(rows)))


def test_salted_join_after_a_shuffle(spark, rows):
    facts = rows.repartition(6).select("id", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("k")).alias("k"))
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = enrich(facts, dim, "k", sizing=LARGE).select(failing_once("id").alias("id"), "k", "v")
    assert whole(joined) and joined.where("v <> k * 10").isEmpty()


def test_averages(spark, rows):
    features = FeatureConfig("k", ("g",), ("v",), ("id",), (), time_column=None)
    facts = rows.withColumn("g", F.lit("a"))
    dim = spark.range(7).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    for sizing in (SizingConfig(), LARGE):
        assert joined_averages(facts, dim, features, sizing).first().avg_id == 499.5
