"""Sources and sinks."""

from __future__ import annotations

import uuid
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from podium.catalog import tables
from podium.config import JdbcConfig, PublishConfig, TopicConfig
from podium.functions import parse_messages
from podium.plans import publish_facts
from podium.sinks.jdbc import run_transaction
from podium.sinks import append_batch, append_rows, write_topic
from podium.sources import ingest_landing, read_csv, read_jdbc, read_topic, stream_topic
from podium.sources.topic import file_options, kafka_options


@pytest.fixture
def database(tmp_path) -> JdbcConfig:
    return JdbcConfig(
        url=f"jdbc:derby:{tmp_path}/db;create=true",
        table="t" + uuid.uuid4().hex[:8],
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def test_csv_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text(
        'athlete_id,name,height\n1,"A, B",180\n2,,""\n3,nan\n4,x,1,extra\n5,"multi\nline",7\n'
    )
    found = ingest_landing(spark, str(tmp_path), "t")
    assert {kind for _, kind in found.dtypes} == {"string"}
    assert [tuple(r) for r in found.collect()] == [
        ("1", "A, B", "180"),
        ("2", None, None),
        ("3", "nan", None),
        ("4", "x", "1"),
        ("5", "multi", None),
        ('line"', "7", None),
    ]


def test_multi_line_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('id,text\n1,"two\nlines, ""quoted"""\n2,b\n')
    found = ingest_landing(spark, str(tmp_path), "t", multi_line=True)
    assert [tuple(r) for r in found.collect()] == [("1", 'two\nlines, "quoted"'), ("2", "b")]


def test_csv_with_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,text\n1,a\n")
    schema = StructType([StructField("id", IntegerType()), StructField("text", StringType())])
    assert tuple(read_csv(spark, str(tmp_path / "t.csv"), schema).first()) == (1, "a")


def test_missing_landing_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest_landing(spark, str(tmp_path), "absent")


def test_documents_split_without_multi_line(spark, tmp_path):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    documents.write.option("header", True).option("escape", '"').csv(str(tmp_path / "documents.csv"))
    assert ingest_landing(spark, str(tmp_path), "documents").count() == 9344
    assert ingest_landing(spark, str(tmp_path), "documents", multi_line=True).count() == 1000


@pytest.mark.parametrize("kind", ["parquet", "text"])
def test_topic_loads_are_final(spark, tmp_path, kind):
    topic = TopicConfig(str(tmp_path / "topic"), kind)
    rows = spark.range(10).selectExpr("id", "concat('line\n', id) AS text")
    write_topic(rows, topic, ["id"], load_id="1")
    before = sorted(p.name for p in (tmp_path / "topic" / "load-1").iterdir())
    write_topic(rows.limit(3), topic, ["id"], load_id="1")
    assert sorted(p.name for p in (tmp_path / "topic" / "load-1").iterdir()) == before
    # What an interrupted load left behind is not read.
    rows.selectExpr("cast('x' as binary) key", "cast('x' as binary) value").write.parquet(f"{topic.name}/_loading-9")
    write_topic(rows, topic, ["id"], load_id="2")
    found = parse_messages(read_topic(spark, topic), rows.schema)
    assert found.count() == 20 and found.exceptAll(rows.union(rows)).isEmpty()
    write_topic(rows, TopicConfig(str(tmp_path / "more"), kind))
    write_topic(rows, TopicConfig(str(tmp_path / "more"), kind))
    assert read_topic(spark, TopicConfig(str(tmp_path / "more"), kind)).count() == 20


def test_topic_records_look_like_kafka(spark, tmp_path):
    topic = TopicConfig(str(tmp_path / "topic"))
    write_topic(spark.range(1).selectExpr("id", "'x' AS v"), topic, ["id"])
    row = read_topic(spark, topic).first()
    assert (bytes(row.key), bytes(row.value)) == (b'{"id":0}', b'{"id":0,"v":"x"}')


def test_unknown_topic_format(spark):
    with pytest.raises(ValueError, match="carrier"):
        read_topic(spark, TopicConfig("x", "carrier"))


def test_kafka_options():
    topic = TopicConfig(
        "results", "kafka", max_per_trigger=500, tolerate_loss=True,
        options={"kafka.bootstrap.servers": "broker:9092"},
    )
    assert kafka_options(topic, streaming=True) == {
        "subscribe": "results",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "kafka.bootstrap.servers": "broker:9092",
        "maxOffsetsPerTrigger": "500",
    }
    strict = replace(topic, tolerate_loss=False)
    assert kafka_options(strict, streaming=False)["failOnDataLoss"] == "true"
    assert "maxOffsetsPerTrigger" not in kafka_options(strict, streaming=False)


def test_kafka_is_asked_for(spark):
    topic = TopicConfig("results", "kafka", options={"kafka.bootstrap.servers": "broker:9092"})
    for use in (
        lambda: stream_topic(spark, topic),
        lambda: read_topic(spark, topic),
        lambda: write_topic(spark.range(1), topic),
    ):
        with pytest.raises(AnalysisException, match="(?i)kafka"):
            use()


def test_file_options():
    topic = TopicConfig("dir", max_per_trigger=4)
    assert file_options(topic, streaming=True)["maxFilesPerTrigger"] == "4"
    assert file_options(topic, streaming=True)["ignoreMissingFiles"] == "false"


def test_secrets_come_from_the_environment(monkeypatch, database):
    monkeypatch.setenv("DB_USER", "reader")
    monkeypatch.setenv("DB_SECRET", "s3")
    table = replace(database, user_env="DB_USER", password_env="DB_SECRET")
    assert table.connection()["user"] == "reader" and "s3" not in repr(table)
    with pytest.raises(KeyError):
        replace(database, user_env="NOT_SET").connection()


@pytest.mark.parametrize("scheme", ("", "file:", "file://"))
def test_embedded_database_below_a_folder_with_a_scheme(spark, tmp_path, monkeypatch, scheme):
    monkeypatch.setattr(tables, "work_folder", lambda _, label: f"{scheme}{tmp_path}/{label}")
    found = tables.database(spark, "rows")
    append_rows(spark.range(3), found)
    assert read_jdbc(spark, found).count() == 3
    assert (tmp_path / "derby").is_dir()


def test_jdbc_partitioned_read(spark, database):
    rows = spark.range(100).selectExpr("id AS k", "id * 0.5D AS v")
    append_rows(rows, database)
    split = replace(database, partition_column='"k"', num_partitions=4)
    found = read_jdbc(spark, split)
    assert found.rdd.getNumPartitions() == 4
    assert found.count() == 100 and found.exceptAll(rows).isEmpty()
    given = replace(split, lower_bound="0", upper_bound="10", num_partitions=2)
    assert read_jdbc(spark, given).count() == 100


def test_jdbc_partitioned_read_of_an_empty_table(spark, database):
    append_rows(spark.range(0).selectExpr("id AS k"), database)
    assert read_jdbc(spark, replace(database, partition_column='"k"')).count() == 0


def test_null_test_reaches_the_database(spark, database):
    append_rows(spark.range(3).selectExpr("id AS k"), database)
    plan = read_jdbc(spark, database).where("k IS NOT NULL AND k = 1")._jdf.queryExecution().toString()
    assert "PushedFilters: [*IsNotNull(k), *EqualTo(k,1)" in plan


def test_batch_is_appended_once(spark, database):
    rows = spark.createDataFrame([("a", 1.0), (None, 2.0), ("c", None)], "k string, v double").coalesce(1)
    append_batch(rows.where("k = 'a'"), database, 0, ["k"])  # as if the rest had failed
    for _ in range(3):
        append_batch(rows, database, 0, ["k"])
    append_batch(rows, database, 1, ["k"])
    found = sorted((r.batch_id, r.k or "", r.v) for r in read_jdbc(spark, database).collect())
    assert [f[:2] for f in found] == [(0, ""), (0, "a"), (0, "c"), (1, ""), (1, "a"), (1, "c")]
    append_batch(rows, database, 0, ["k"], stream=5)
    append_batch(rows.union(rows), database, 2, ["k"])  # as if a task had repeated its rows
    counts = {(r.stream_id, r.batch_id): r["count"] for r in read_jdbc(spark, database).groupBy("stream_id", "batch_id").count().collect()}
    assert counts == {(0, 0): 3, (0, 1): 3, (5, 0): 3, (0, 2): 3}


def test_failed_transaction_changes_nothing(spark, database):
    rows = spark.createDataFrame([("a", 1.0)], "k string, v double")
    append_batch(rows, database, 0, ["k"])
    with pytest.raises(Exception, match="(?i)syntax|error"):
        run_transaction(spark, database, [], [f"DELETE FROM {database.table}", "NO SQL"], [])
    assert read_jdbc(spark, database).count() == 1


def test_publish_table(spark, database, tmp_path):
    rows = spark.createDataFrame([(1, "Gold"), (2, None)], "athlete_id int, medal string")
    append_rows(rows, database)
    topic = TopicConfig(str(tmp_path / "topic"))
    publish_facts(spark, PublishConfig(topic, database, load_id="all"))
    values = {bytes(r.value) for r in read_topic(spark, topic).collect()}
    assert values == {b'{"athlete_id":1,"medal":"Gold"}', b'{"athlete_id":2}'}
