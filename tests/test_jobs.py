"""Settings files and spark-submit scripts."""

from __future__ import annotations

import importlib
import json
import sys
from dataclasses import asdict
from pathlib import Path

import pytest

from podium.config import (
    JdbcConfig,
    LakeConfig,
    PublishConfig,
    RollingConfig,
    StreamConfig,
    StreamJobConfig,
    TopicConfig,
    from_dict,
    load,
)
from podium.schemas import TOPIC_RECORD
from podium.sinks import append_rows, write_topic
from podium.sources import read_jdbc, read_topic
from test_lake import BIO, GOLD, RESULTS, _gold

JOBS = Path(__file__).resolve().parent.parent / "jobs"
sys.path.insert(0, str(JOBS))


def run(job: str, tmp_path: Path, settings, *arguments: str) -> None:
    path = tmp_path / f"{job}.json"
    path.write_text(json.dumps(asdict(settings)))
    importlib.import_module(job).main(["--config", str(path), *arguments])


@pytest.mark.parametrize(
    ("name", "kind"),
    [("lake", LakeConfig), ("publish", PublishConfig), ("feature_stream", StreamJobConfig)],
)
def test_example_settings(name, kind):
    found = load(kind, str(JOBS / "conf" / f"{name}.json"))
    assert isinstance(found, kind)


def test_settings_round_trip():
    job = StreamJobConfig(
        StreamConfig(TopicConfig("t"), "c", "h", out_table=JdbcConfig("u", "t")), rolling=RollingConfig()
    )
    assert from_dict(StreamJobConfig, json.loads(json.dumps(asdict(job)))) == job


def test_unknown_settings_are_errors():
    with pytest.raises(ValueError, match="brnze"):
        from_dict(LakeConfig, {"brnze": "x"})


def test_lake_job(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "athlete_bio.csv").write_text(BIO)
    (landing / "athlete_event_results.csv").write_text(RESULTS)
    lake = LakeConfig(*(str(tmp_path / layer) for layer in ("landing", "bronze", "silver", "gold")))
    for stage in ("landing_to_bronze", "bronze_to_silver", "silver_to_gold"):
        run("lake", tmp_path, lake, "--stage", stage)
    assert _gold(spark.read.parquet(f"{lake.gold}/avg_stats")) == GOLD
    run("lake", tmp_path, lake)
    assert _gold(spark.read.parquet(f"{lake.gold}/avg_stats")) == GOLD


def test_publish_and_stream_jobs(spark, tmp_path):
    """Database to topic to features in a topic and a table."""

    def table(name: str) -> JdbcConfig:
        driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
        return JdbcConfig(f"jdbc:derby:{tmp_path}/db;create=true", name, driver)

    facts = [(1, "USA", "Gold", "Judo"), (2, "FRA", "Gold", "Judo"), (1, "USA", "nan", "Judo")]
    append_rows(
        spark.createDataFrame(facts, "athlete_id int, country_noc string, medal string, sport string"),
        table("results"),
    )
    bios = [(1, "M", "180", "80"), (2, "F", "nan", "60")]
    append_rows(
        spark.createDataFrame(bios, "athlete_id int, sex string, height string, weight string"),
        table("bios"),
    )
    topic = TopicConfig(str(tmp_path / "topic"))
    run("publish", tmp_path, PublishConfig(topic, table("results"), load_id="1"))
    assert read_topic(spark, topic).schema == TOPIC_RECORD
    stream = StreamConfig(
        topic, str(tmp_path / "c"), str(tmp_path / "h"), out_table=table("features"), state_partitions=2
    )
    run("feature_stream", tmp_path, StreamJobConfig(stream, dim_table=table("bios")))
    (row,) = read_jdbc(spark, table("features")).drop("calculated_at", "stream_id").collect()
    assert row.asDict() == {
        "sport": "Judo", "medal": "Gold", "country_noc": "USA", "sex": "M",
        "avg_height": 180.0, "avg_weight": 80.0, "batch_id": 0,
    }


def test_rolling_job(spark, tmp_path):
    rows = spark.sql(
        "SELECT 1 AS athlete_id, 'Judo' AS sport, 'Gold' AS medal, 'USA' AS country_noc, "
        "timestamp_seconds(1700000000 + 3600 * id) AS timestamp FROM range(49)"
    )
    topic = TopicConfig(str(tmp_path / "topic"))
    write_topic(rows, topic)
    spark.sql("SELECT 1 AS athlete_id, 'M' AS sex, 180D AS height, 80D AS weight").write.parquet(
        str(tmp_path / "bio")
    )
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    table = JdbcConfig(f"jdbc:derby:{tmp_path}/db;create=true", "windows", driver)
    stream = StreamConfig(
        topic, str(tmp_path / "c"), str(tmp_path / "h"), state_partitions=2,
        out_topic=TopicConfig(str(tmp_path / "out")), out_table=table,
    )
    job = StreamJobConfig(stream, dim_path=str(tmp_path / "bio"), rolling=RollingConfig())
    run("feature_stream", tmp_path, job)
    found = spark.read.parquet(stream.history)
    assert [r.avg_height for r in found.collect()] == [180.0, 180.0]
    stored = read_jdbc(spark, table)
    stored = stored.drop("stream_id", "batch_id")
    assert stored.exceptAll(found.select(stored.columns)).isEmpty()
    assert stored.count() == read_topic(spark, stream.out_topic).count() == 2


def test_stream_job_needs_one_dimension(tmp_path):
    stream = StreamConfig(TopicConfig("t"), "c", "h")
    with pytest.raises(ValueError, match="dim_table"):
        run("feature_stream", tmp_path, StreamJobConfig(stream))
