"""Parked messages, versioned tables, compacted histories, readers of repeated output, windows from panes."""

from __future__ import annotations

import os
from collections import Counter
from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from podium.config import FeatureConfig, LakeConfig, ParkingConfig, RollingConfig, SizingConfig, StreamConfig, TopicConfig
from podium.functions import judge_messages
from podium.operators import latest_per_key, rolling_averages
from podium.operators.aggregates import pane_length
from podium.plans import run_lake
from podium.session import names_in
from podium.sinks import compact_history, read_history, read_latest, replace_table, write_topic
from podium.sinks.files import table_versions
from podium.sinks.topic import write_records
from podium.sources import read_table, read_topic, stream_once
from podium.streaming import decided, read_features, read_rejects, run_feature_stream, run_parked_stream
from podium.streaming.features import await_all, feature_schema, start
from podium.streaming.parking import Gate, versions
from podium.streaming.rolling import run_rolling_stream

FACT = StructType(
    [StructField("k", LongType()), StructField("g", StringType()), StructField("v", LongType()), StructField("at", TimestampType())]
)
FEATURES = FeatureConfig(
    key="k", fact_keys=("g",), dim_keys=("d",), fact_measures=("v",), dim_measures=("m",), measure_type="double",
    time_column="calculated_at",
)


def facts_of(spark, rows):
    frame = spark.createDataFrame(rows, "k long, g string, v long, at string")
    return frame.withColumn("at", F.col("at").cast("timestamp"))


@pytest.fixture
def stream(tmp_path):
    return StreamConfig(
        topic=TopicConfig(str(tmp_path / "topic")), checkpoint=str(tmp_path / "checkpoint"), history=str(tmp_path / "history"),
        features=FEATURES, sentinel_column=None, required=(), state_partitions=2,
    )


@pytest.fixture
def parking(tmp_path):
    return ParkingConfig(str(tmp_path / "parked"), TopicConfig(str(tmp_path / "ready")), "at", "5 days")


@pytest.fixture
def dims(spark):
    rows = [(k, f"d{k % 2}", str(10 * k)) for k in range(1, 6)]
    whole = spark.createDataFrame(rows, "k long, d string, m string")
    return lambda *keys: whole.where(F.col("k").isin(*keys))


def totals(spark, stream, dim):
    rows = latest_per_key(read_features(spark, stream, FACT, dim), FEATURES.keys).collect()
    return {(r.g, r.d): (r.avg_v, r.avg_m) for r in rows}


def statuses(spark, parking):
    return Counter(r.status for r in decided(spark, parking).collect())


# ---- parked messages


def test_messages_wait_for_their_dimension(spark, stream, parking, dims):
    def round_(dim):
        run_parked_stream(spark, stream, parking, lambda: dim, FACT, rounds=1)

    write_topic(facts_of(spark, [(1, "a", 1, "2024-01-01"), (2, "a", 5, "2024-01-01"), (None, "a", 9, "2024-01-01")]), stream.topic, load_id="0")
    round_(dims(1))
    assert totals(spark, stream, dims(1)) == {("a", "d1"): (1.0, 10.0)}
    assert statuses(spark, parking) == {"ready": 2, "parked": 1}
    round_(dims(1, 2))  # no new message
    assert totals(spark, stream, dims(1)) == {("a", "d1"): (1.0, 10.0), ("a", "d0"): (5.0, 20.0)}
    write_topic(facts_of(spark, [(3, "a", 7, "2024-01-02"), (4, "a", 7, None)]), stream.topic, load_id="1")
    round_(dims(1, 2))
    write_topic(facts_of(spark, [(1, "a", 3, "2024-01-09")]), stream.topic, load_id="2")
    round_(dims(1, 2))
    assert statuses(spark, parking) == {"ready": 4, "expired": 2}
    round_(dims(1, 2, 3, 4))  # too late
    assert totals(spark, stream, dims(1)) == {("a", "d1"): (2.0, 10.0), ("a", "d0"): (5.0, 20.0)}
    expired = decided(spark, parking).where("status = 'expired'").select(F.col("value").cast("string")).collect()
    assert sorted('"k":3' in r.value for r in expired) == [False, True]


def test_a_key_held_by_most_messages_is_salted(spark, stream, parking, dims):
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1, hot_share=0.05), state_partitions=None)
    rows = [(1 if i % 3 else 1 + i % 5, "a", i, "2024-01-01") for i in range(300)]
    write_topic(facts_of(spark, rows), stream.topic, load_id="0")
    for known in ([2], [1, 2, 3, 4, 5]):
        run_parked_stream(spark, stream, parking, lambda known=known: dims(*known), FACT, rounds=1)
    assert statuses(spark, parking) == {"ready": 300}
    found = totals(spark, stream, dims(1))
    for d in ("d0", "d1"):
        own = [v for k, _, v, _ in rows if f"d{k % 2}" == d]
        assert found["a", d][0] == pytest.approx(sum(own) / len(own))


@pytest.mark.parametrize("moment", ["version", "publish", "commit"])
def test_a_crash_between_the_steps(spark, stream, parking, dims, monkeypatch, moment):
    """Each moment: before the version is there, before it is published, before the batch is committed."""
    write_topic(facts_of(spark, [(1, "a", 1, "2024-01-01"), (2, "a", 5, "2024-01-01")]), stream.topic, load_id="0")
    run_parked_stream(spark, stream, parking, lambda: dims(1), FACT, rounds=1)
    write_topic(facts_of(spark, [(1, "a", 3, "2024-01-01"), (2, "a", 7, "2024-01-01")]), stream.topic, load_id="1")
    with monkeypatch.context() as patch:
        if moment == "version":
            patch.setattr("podium.streaming.parking.move_into_place", lambda *_: 1 / 0)
        elif moment == "publish":
            patch.setattr(Gate, "publish", lambda *_: 1 / 0)
        else:
            real = Gate.advance

            def advance(self, origin, messages=None):
                real(self, origin, messages)
                if origin.startswith("batch"):
                    raise RuntimeError("driver lost")

            patch.setattr(Gate, "advance", advance)
        with pytest.raises(Exception):  # noqa: B017 - the stream wraps it
            run_parked_stream(spark, stream, parking, lambda: dims(1), FACT, rounds=1)
    for _ in range(2):
        run_parked_stream(spark, stream, parking, lambda: dims(1, 2), FACT, rounds=1)
    assert totals(spark, stream, dims(1)) == {("a", "d1"): (2.0, 10.0), ("a", "d0"): (6.0, 20.0)}
    assert statuses(spark, parking) == {"ready": 4}
    assert read_topic(spark, parking.ready).count() == 4
    numbers = [v.number for v in versions(spark, parking)]
    assert numbers == list(range(len(numbers)))


def test_nothing_published_yet(spark, stream, parking, dims):
    assert decided(spark, parking).count() == 0
    write_topic(facts_of(spark, [(2, "a", 5, "2024-01-01")]), stream.topic, load_id="0")
    run_parked_stream(spark, stream, parking, lambda: dims(1), FACT, rounds=1)
    assert statuses(spark, parking) == {"parked": 1}


# ---- versioned tables


def test_a_failed_write_leaves_the_version_before(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_table(spark, path)
    assert replace_table(spark.range(10), path) == 0
    reader = read_table(spark, path)
    broken = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") == 990, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(PySparkException):
        replace_table(broken, path)
    assert reader.count() == read_table(spark, path).count() == 10
    assert len(names_in(spark, path, hidden=True)) == 1
    assert replace_table(spark.range(20), path) == 1
    assert (reader.count(), read_table(spark, path).count()) == (10, 20)
    assert names_in(spark, path, hidden=True) == []
    replace_table(spark.range(30), path)
    assert table_versions(spark, path) == [1, 2]
    assert replace_table(spark.range(99), path, version=2) == 2 and read_table(spark, path).count() == 30


def test_versioned_lake(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "athlete_bio.csv").write_text("athlete_id,country_noc,sex,height,weight\n1,USA,Male,180,80\n")
    (landing / "athlete_event_results.csv").write_text("athlete_id,country_noc,medal,sport\n1,USA,Gold,Judo\n")
    lake = LakeConfig(str(landing), str(tmp_path / "b"), str(tmp_path / "s"), str(tmp_path / "g"), versioned=True)
    first = run_lake(spark, lake)
    assert [(r.sport, r.avg_height) for r in first.collect()] == [("Judo", 180.0)]
    os.unlink(landing / "athlete_event_results.csv")
    with pytest.raises(PySparkException):
        run_lake(spark, lake)
    assert read_table(spark, f"{lake.gold}/avg_stats").count() == 1


# ---- compaction


def _batches(spark, history, many):
    for i in range(many):
        rows = [(f"g{(i + j) % 5}", float(i)) for j in range(2)]
        spark.createDataFrame(rows, "g string, x double").coalesce(1).write.parquet(f"{history}/batch_id={i}")


def test_compaction(spark, tmp_path, monkeypatch):
    history = str(tmp_path / "h")
    schema = StructType([StructField("g", StringType()), *spark.createDataFrame([], "x double").schema.fields])
    assert compact_history(spark, history, schema, ["g"]) is None
    _batches(spark, history, 7)
    wanted = {tuple(r) for r in latest_per_key(read_history(spark, history, schema), ["g"]).collect()}

    def found():
        return {tuple(r) for r in read_latest(spark, history, schema, ["g"]).collect()}

    assert found() == wanted
    with monkeypatch.context() as patch:
        patch.setattr("podium.sinks.files.move_into_place", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compact_history(spark, history, schema, ["g"])
    assert found() == wanted
    assert compact_history(spark, history, schema, ["g"]) == 6
    assert found() == wanted
    files = read_latest(spark, history, schema, ["g"]).inputFiles()
    assert files and not any("batch_id=" in f for f in files)
    spark.createDataFrame([("g0", 50.0)], "g string, x double").write.parquet(f"{history}/batch_id=7")
    (Path(history) / "batch_id=8").mkdir()  # not whole
    wanted = {w for w in wanted if w[0] != "g0"} | {("g0", 50.0, 7)}
    assert found() == wanted
    assert compact_history(spark, history, schema, ["g"], drop=True) == 7
    assert found() == wanted and names_in(spark, history) == ["batch_id=7", "batch_id=8"]


# ---- readers of repeated output


def test_repeated_loads_are_read_once(spark, stream, dims, tmp_path):
    stream = replace(stream, out_topic=TopicConfig(str(tmp_path / "out")))
    dim = dims(1, 2, 3)
    reader = str(tmp_path / "reader")

    def read():
        rows = stream_once(spark, stream.out_topic, feature_schema(stream, FACT, dim), FEATURES.keys, "calculated_at", "1 day")
        await_all([start(rows.writeStream.option("path", str(tmp_path / "rows")), reader)])
        return spark.read.parquet(str(tmp_path / "rows"))

    seen = 0
    for i in range(3):
        write_topic(facts_of(spark, [(k, "a", i, "2024-01-01") for k in range(1, 6)]), stream.topic, load_id=str(i))
        run_feature_stream(spark, stream, dim, FACT)
        if i == 1:
            write_records(read_topic(spark, stream.out_topic), stream.out_topic, load_id="again")
        seen = read().count()
    rows = read()
    assert seen == rows.count() == rows.select("batch_id", "g", "d").distinct().count() == 6


# ---- panes


@pytest.mark.parametrize("size, slide", [("3 hours", "2 hours"), ("1 hour", "20 minutes"), ("90 minutes", "1 hour"), ("1 hour", None)])
@pytest.mark.parametrize("kind", ["double", "decimal(8,3)", "int"])
def test_panes_equal_copied_rows(spark, size, slide, kind):
    rows = spark.range(3000).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919) % 90_000).alias("at"),
        (F.col("id") % 3).alias("g"),
        F.when(F.col("id") % 11 > 0, (F.col("id") % 100) / 7).cast(kind).alias("v"),
    )
    rows = rows.union(spark.createDataFrame([(None, 1, None)], rows.schema))
    found = rolling_averages(rows, "at", size, ["g"], ["v"], slide)
    window = F.window("at", size, slide or size)
    wanted = rows.groupBy(window.alias("w"), "g").agg(F.avg("v").alias("avg_v"), F.count(F.lit(1)).alias("n_rows"))
    wanted = wanted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "g", "avg_v", "n_rows")
    assert found.dtypes == wanted.dtypes
    order = ["window_start", "g"]
    for a, b in zip(found.orderBy(*order).collect(), wanted.orderBy(*order).collect(), strict=True):
        assert tuple(a)[:3] == tuple(b)[:3] and a.n_rows == b.n_rows
        assert a.avg_v == b.avg_v if kind.startswith("decimal") else a.avg_v == pytest.approx(b.avg_v)


def test_panes_are_expanded_not_rows(spark):
    rows = spark.range(100).select(F.timestamp_seconds("id").alias("at"), F.col("id").alias("v"))
    plan = rolling_averages(rows, "at", "1 day", [], ["v"], "1 hour")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    (expand,) = [i for i, line in enumerate(lines) if "Expand" in line]
    assert any("Aggregate" in line for line in lines[expand + 1 :])
    assert pane_length(spark, "90 minutes", "1 hour") == ("1800000000 microseconds", True)


@pytest.mark.parametrize("panes", [True, False])
def test_sliding_stream(spark, stream, dims, panes, tmp_path):
    rows = [(1 + i % 3, "a", i, f"2024-01-01 {i // 4:02d}:{15 * (i % 4):02d}:00") for i in range(60)]
    for part in range(3):
        write_topic(facts_of(spark, rows[20 * part : 20 * part + 20]).coalesce(1), stream.topic, load_id=str(part))
    stream = replace(stream, topic=replace(stream.topic, max_per_trigger=1))
    rolling = RollingConfig("at", "3 hours", "2 hours", delay="1 hour", panes=panes)
    schema = run_rolling_stream(spark, stream, rolling, dims(1, 2, 3), FACT)
    found = read_history(spark, stream.history, schema).collect()
    last = "2024-01-01 13:45:00"  # the newest event less the delay
    wanted = {}
    for k, g, v, at in rows:
        hour = int(at[11:13])
        for begin in range(-2, 24, 2):
            if begin <= hour < begin + 3 and begin + 3 <= int(last[11:13]):
                wanted.setdefault((begin, g, f"d{k % 2}"), []).append(v)
    got = {(round((r.window_start.timestamp() - 1704067200) / 3600), r.g, r.d): r.avg_v for r in found}
    assert len(got) == len(found)
    assert sorted(got) == sorted(wanted)
    assert got == pytest.approx({key: sum(v) / len(v) for key, v in wanted.items()})


# ---- rejected messages


def test_reasons(spark):
    schema = StructType([StructField("a", LongType()), StructField("b", StringType()), StructField("t", TimestampType())])
    told = {
        '{"a":1,"b":"x"}': (None, None), '{"a":1}': (None, None), '{"b":"x"}': ("incomplete", ["a"]), "{}": ("incomplete", ["a"]),
        '{"a":null}': ("incomplete", ["a"]), '{"a":"one","b":"x"}': ("wrong type", ["a"]), '{"a":1,"t":"noon"}': ("wrong type", ["t"]),
        '{"a":1': ("no json", None), "words": ("no json", None), "[1]": ("no object", None), "17": ("no object", None),
        '"text"': ("no object", None), "  ": ("empty", None), "": ("empty", None), None: ("missing", None),
        '  {"a":2} ': (None, None), '{"a":1,"more":{"x":[1]}}': (None, None),
    }
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(told)], "i int, value string")
    found = judge_messages(rows, schema, keep=["i"], required=["a"]).orderBy("i").collect()
    assert {r.raw: (r.reason, r.wrong) for r in found} == told
    assert found[0].a == 1 and found[5].b == "x" and found[5].a is None


def test_a_corrupt_message_is_looked_at_once(spark):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(['{"a":"x"}', '{"a":1', "x", '{"a":1}x', "NaN", "true", "{\n"])], "i int, value string")
    found = judge_messages(rows, StructType([StructField("a", LongType())]), keep=["i"], required=["a"]).where("reason is not null")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils.parseJson") == 1 and "get_json_object" not in plan
    reasons = ["wrong type", "no json", "no json", "no json", "no object", "no json"]
    assert [r.reason for r in found.orderBy("i").collect()] == reasons


def row_groups(folder):
    """Row groups that hold the most rows of a file there."""
    files = [pq.ParquetFile(path).metadata for path in Path(folder).rglob("*.parquet")]
    return max(files, key=lambda m: m.num_rows).num_row_groups


def test_tasks_can_share_a_file_of_messages(spark, stream, dims, parking):
    facts = spark.range(150_000).coalesce(1).selectExpr(
        "id k", "'a' g", "id v", "timestamp '2024-01-01' at", "sha2(id || '', 256) more"
    )
    write_topic(facts, stream.topic, load_id="0")
    assert row_groups(stream.topic.name) > 1
    run_parked_stream(spark, stream, parking, lambda: dims(1), FACT, rounds=1)
    assert row_groups(parking.folder) > 1
    assert decided(spark, parking).count() == 150_000


def test_rejects_of_a_stream(spark, stream, dims, tmp_path):
    stream = replace(stream, rejects=str(tmp_path / "rejects"))
    good = facts_of(spark, [(1, "a", 1, "2024-01-01")])
    write_topic(good, stream.topic, load_id="0")
    run_feature_stream(spark, stream, dims(1), FACT)
    assert read_rejects(spark, stream).count() == 0
    bad = spark.createDataFrame([(None, '{"k":1,"g":"a"}'), (None, "{"), (None, '{"k":"x","g":"a","v":1}')], "key string, value string")
    write_records(bad, stream.topic, load_id="1")
    for _ in range(2):
        run_feature_stream(spark, stream, dims(1), FACT)
    found = read_rejects(spark, stream).collect()
    assert sorted((r.reason, r.raw, r.batch_id) for r in found) == [
        ("incomplete", '{"k":1,"g":"a"}', 1), ("no json", "{", 1), ("wrong type", '{"k":"x","g":"a","v":1}', 1),
    ]
    assert all("load-1" in r.source for r in found)
    assert totals(spark, stream, dims(1)) == {("a", "d1"): (1.0, 10.0)}
