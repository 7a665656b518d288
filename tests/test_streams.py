"""The feature stream: equal to the batch, safe to restart and replay."""

from __future__ import annotations

import os
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from podium.config import JdbcConfig, RollingConfig, SizingConfig, StreamConfig, TopicConfig
from podium.operators import latest_per_key, rolling_averages
from podium.schemas import RESULT_MESSAGE, TIMED_RESULT_MESSAGE
from podium.sinks import read_history, write_topic
from podium.sinks.history import stream_id
from podium.sources import read_jdbc, read_topic
from podium.streaming import features, prepare_dimension, read_features, run_feature_stream, run_rolling_stream
from podium.functions import parse_messages
from podium.streaming.features import await_all, feature_schema, sinks_of, start_feature_stream

KEYS = ["sport", "medal", "country_noc", "sex"]


@pytest.fixture
def stream(tmp_path) -> StreamConfig:
    return StreamConfig(
        topic=TopicConfig(str(tmp_path / "topic")),
        checkpoint=str(tmp_path / "checkpoint"),
        history=str(tmp_path / "history"),
        state_partitions=2,
    )


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(i, "M" if i % 2 else "F", str(150 + i % 40), "nan" if i == 3 else str(50.5 + i % 30)) for i in range(40)]
        + [(50, None, "180", "80"), (51, "M", None, "80"), (52, "M", "1,85", "80"), (None, "F", "1", "1")],
        "athlete_id int, sex string, height string, weight string",
    )


@pytest.fixture
def results(spark):
    return spark.range(800).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 60).cast("int").alias("athlete_id"),
        F.concat(F.lit("sport"), F.col("id") % 4).alias("sport"),
        F.when(F.col("id") % 5 == 0, "nan").when(F.col("id") % 7 == 0, None).otherwise("Gold").alias("medal"),
        F.when(F.col("id") % 2 == 0, "USA").alias("country_noc"),
        F.col("id").cast("int").alias("result_id"),
    )


def batch_answer(results, dim):
    """Plain left join, filter and averages."""
    dim = dim.withColumns({c: F.col(c).try_cast("double") for c in ("height", "weight")})
    joined = results.join(dim, "athlete_id", "left").where(
        "height IS NOT NULL AND NOT isnan(height) AND weight IS NOT NULL AND NOT isnan(weight) "
        "AND sex IS NOT NULL AND medal <> 'nan'"
    )
    return as_dict(joined.groupBy(*KEYS).agg(F.avg("height").alias("avg_height"), F.avg("weight").alias("avg_weight")))


def as_dict(frame):
    rows = frame.select(*KEYS, F.round("avg_height", 6), F.round("avg_weight", 6)).collect()
    assert len({tuple(r)[:4] for r in rows}) == len(rows)
    return {tuple(r)[:4]: tuple(r)[4:] for r in rows}


def latest(spark, stream, dim):
    return as_dict(latest_per_key(read_features(spark, stream, RESULT_MESSAGE, dim), KEYS))


def batches(spark, stream, dim):
    counts = read_features(spark, stream, RESULT_MESSAGE, dim).groupBy("batch_id").count().collect()
    return {r.batch_id: r["count"] for r in counts}


def last_commit_lost(checkpoint: str) -> None:
    """As if the driver had died between the sinks and the commit."""
    commits = Path(checkpoint) / "commits"
    newest = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    os.unlink(commits / str(newest))
    (commits / f".{newest}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("files", [1, 4, 16])
def test_stream_equals_batch(spark, stream, dim, results, files):
    write_topic(results.repartition(files), stream.topic, ["athlete_id"])
    stream = replace(stream, topic=replace(stream.topic, max_per_trigger=-(-files // 4)))
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)
    assert len(batches(spark, stream, dim)) == min(files, 4)


def test_large_dimension_equals_batch(spark, stream, dim, results):
    write_topic(results.repartition(3), stream.topic)
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1))
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_large_dimension_is_not_shuffled_per_batch(spark, stream, dim, results):
    write_topic(results, stream.topic)
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1, hot_share=0.05))
    (query,) = start_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    await_all([query])
    plan = query._jsq.explainInternal(False)
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and "rand(" in plan
    # One exchange for the messages, one for the partial sums.
    assert plan.count("Exchange hashpartitioning") == 2
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_large_dimension_over_several_runs(spark, stream, dim, results):
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1, hot_share=0.05))
    for load in range(3):
        write_topic(results.where(f"result_id % 3 = {load}"), stream.topic, load_id=str(load))
        run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
        # As a later application without this catalog: the files stay, the table is unknown.
        for table in spark.catalog.listTables():
            if table.name.startswith("podium_dimension_"):
                spark.sql(f"DROP TABLE {table.name}")
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_unknown_required_column_is_an_error(spark, stream, dim):
    with pytest.raises(ValueError, match="sexx"):
        prepare_dimension(spark, dim, replace(stream, required=("sexx",)), RESULT_MESSAGE)


def test_required_message_column(spark, stream, dim, results):
    write_topic(results, stream.topic)
    run_feature_stream(spark, replace(stream, required=("sex", "country_noc")), dim, RESULT_MESSAGE)
    answer = batch_answer(results.where("country_noc IS NOT NULL"), dim)
    assert latest(spark, stream, dim) == answer


def test_hot_keys_are_looked_up_once(spark, stream, dim, results, monkeypatch):
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1, hot_share=0.05))
    write_topic(results.where("result_id < 400"), stream.topic, load_id="0")
    first = prepare_dimension(spark, dim, stream, RESULT_MESSAGE)
    assert list(first.hot.values()) == [[7]]
    monkeypatch.setattr(features, "read_topic", None)
    assert prepare_dimension(spark, dim, stream, RESULT_MESSAGE).hot == first.hot


def test_large_dimension_before_the_first_message(spark, stream, dim, results):
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1, hot_share=0.05))
    prepared = prepare_dimension(spark, dim, stream, RESULT_MESSAGE)  # there is no topic yet
    assert prepared.hot == {}
    write_topic(results, stream.topic, load_id="0")
    run_feature_stream(spark, stream, prepared, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)
    # Nothing was remembered of the empty start.
    assert list(prepare_dimension(spark, dim, stream, RESULT_MESSAGE).hot.values()) == [[7]]


def test_text_keys_in_messages(spark, stream, dim, results):
    schema = StructType([StructField("athlete_id", StringType()), *RESULT_MESSAGE.fields[2:]])
    write_topic(results.withColumn("athlete_id", F.col("athlete_id").cast("string")), stream.topic)
    for sizing in (SizingConfig(), SizingConfig(broadcast_bytes=-1)):
        one = replace(stream, sizing=sizing, history=f"{stream.history}{sizing.broadcast_bytes}", checkpoint=f"{stream.checkpoint}{sizing.broadcast_bytes}")
        run_feature_stream(spark, one, dim, schema)
        assert latest(spark, one, dim) == batch_answer(results, dim)


def test_repeated_dimension_rows_count_like_the_join(spark, stream, dim, results):
    dim = dim.union(dim).union(dim.where("athlete_id = 7").withColumn("height", F.lit("200")))
    write_topic(results, stream.topic)
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_restart_adds_only_new_messages(spark, stream, dim, results):
    write_topic(results.where("result_id < 500"), stream.topic, load_id="1")
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    before = batches(spark, stream, dim)
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert batches(spark, stream, dim) == before
    write_topic(results.where("result_id >= 500"), stream.topic, load_id="2")
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_one_time_per_batch(spark, stream, dim, results):
    write_topic(results.repartition(3), stream.topic)
    stream = replace(stream, topic=replace(stream.topic, max_per_trigger=1))
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    times = read_features(spark, stream, RESULT_MESSAGE, dim).groupBy("batch_id").agg(
        F.count_distinct("calculated_at").alias("n"), F.max("calculated_at").alias("at")
    )
    found = times.orderBy("batch_id").collect()
    assert [r.n for r in found] == [1, 1, 1] and found[0].at < found[1].at < found[2].at


def test_update_mode_emits_touched_groups_only(spark, stream, dim, results):
    write_topic(results, stream.topic, load_id="1")
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    one = spark.createDataFrame([(7, "sport0", "Gold", "USA", 1)], "athlete_id int, sport string, medal string, country_noc string, result_id int")
    write_topic(one, stream.topic, load_id="2")
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert batches(spark, stream, dim)[1] == 1


def test_empty_batch_reaches_no_sink(spark, stream, dim, results):
    write_topic(results.where("medal = 'nan'"), stream.topic)
    called = []
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE, {"x": lambda df, i: called.append(i)})
    assert called == [] and latest(spark, stream, dim) == {}


def test_malformed_messages_are_dropped(spark, stream, dim, results):
    write_topic(results, stream.topic)
    junk = spark.createDataFrame([(None, b"not json"), (None, b""), (None, b"[1]"), (None, None)], "key binary, value binary")
    junk.write.mode("append").parquet(stream.topic.name)
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


@pytest.fixture
def both_sinks(stream, tmp_path) -> StreamConfig:
    table = JdbcConfig(
        url=f"jdbc:derby:{tmp_path}/db;create=true", table="features",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )
    return replace(stream, out_topic=TopicConfig(str(tmp_path / "out")), out_table=table)


def test_replayed_batch_changes_no_sink(spark, both_sinks, dim, results):
    stream = both_sinks
    for load in range(2):
        write_topic(results.where(f"result_id % 2 = {load}"), stream.topic, load_id=str(load))
        run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    before = batches(spark, stream, dim)
    table, topic = read_jdbc(spark, stream.out_table), read_topic(spark, stream.out_topic)
    assert table.count() == topic.count() == sum(before.values())
    last_commit_lost(f"{stream.checkpoint}/main")
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert batches(spark, stream, dim) == before
    assert read_jdbc(spark, stream.out_table).count() == sum(before.values())
    assert read_topic(spark, stream.out_topic).count() == sum(before.values())
    answer = batch_answer(results, dim)
    assert as_dict(latest_per_key(read_jdbc(spark, stream.out_table), KEYS)) == answer
    schema = StructType([*feature_schema(stream, RESULT_MESSAGE, dim).fields, StructField("batch_id", LongType())])
    in_topic = parse_messages(read_topic(spark, stream.out_topic), schema)
    assert as_dict(latest_per_key(in_topic.union(in_topic), KEYS)) == answer


def test_failing_sink_does_not_stop_the_other_and_is_retried(spark, both_sinks, dim, results):
    stream = both_sinks
    write_topic(results, stream.topic)
    working = sinks_of(stream, stream_id(spark, f"{stream.checkpoint}/main"))
    broken = {"topic": lambda df, i: 1 / 0, "table": working["table"]}
    with pytest.raises(StreamingQueryException, match="division by zero"):
        run_feature_stream(spark, stream, dim, RESULT_MESSAGE, broken)
    answer = batch_answer(results, dim)
    assert read_jdbc(spark, stream.out_table).count() == len(answer)
    assert not Path(stream.out_topic.name).exists()
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert read_jdbc(spark, stream.out_table).count() == len(answer)
    assert read_topic(spark, stream.out_topic).count() == len(answer)


def test_history_of_another_checkpoint_is_refused(spark, stream, dim, results):
    for load in range(2):
        write_topic(results.where(f"result_id % 2 = {load}"), stream.topic, load_id=str(load))
        run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
        before = batches(spark, stream, dim)
        with pytest.raises(ValueError, match="another checkpoint"):
            run_feature_stream(spark, replace(stream, checkpoint=f"{stream.checkpoint}2"), dim, RESULT_MESSAGE)
        assert batches(spark, stream, dim) == before


def test_replayed_load_counts_once(spark, stream, dim, results):
    for load in (0, 1, 1):
        write_topic(results.where(f"result_id % 2 = {load}"), stream.topic, load_id=str(load))
        run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_large_dimension_joins_in_the_sessions_partitions(spark, stream, dim, results):
    write_topic(results, stream.topic)
    stream = replace(stream, sizing=SizingConfig(broadcast_bytes=-1), state_partitions=3)
    (query,) = start_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    await_all([query])
    plan = query._jsq.explainInternal(False)
    assert ", 8)" in plan and ", 3)" not in plan
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_fractional_dimension_keys_meet_nothing(spark, stream, dim, results):
    write_topic(results, stream.topic)
    halves = dim.withColumn("athlete_id", F.col("athlete_id").cast("double"))
    off = halves.withColumn("athlete_id", F.col("athlete_id") + 0.5)
    run_feature_stream(spark, stream, halves.union(off), RESULT_MESSAGE)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_rolling_without_event_time_is_an_error(spark, stream, dim, results):
    write_topic(results, stream.topic)
    with pytest.raises(ValueError, match="none of"):
        run_rolling_stream(spark, stream, RollingConfig(), dim, TIMED_RESULT_MESSAGE)


def test_complete_snapshot(spark, stream, dim, results, tmp_path):
    stream = replace(stream, snapshot=str(tmp_path / "snapshot"))
    write_topic(results.repartition(2), stream.topic)
    stream = replace(stream, topic=replace(stream.topic, max_per_trigger=1))
    run_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    assert as_dict(spark.read.parquet(stream.snapshot)) == batch_answer(results, dim)
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_failure_of_one_query_stops_the_other(spark, stream, dim, results, tmp_path):
    stream = replace(
        stream, snapshot=str(tmp_path / "snapshot"), snapshot_trigger="1 hour", trigger="1 second"
    )
    write_topic(results, stream.topic)
    started = start_feature_stream(spark, stream, dim, RESULT_MESSAGE, {"x": lambda df, i: 1 / 0})
    with pytest.raises(StreamingQueryException, match="division by zero"):
        await_all(started)
    assert not any(query.isActive for query in started)


def test_progress_tells_the_rows_of_a_batch(spark, stream, dim, results):
    write_topic(results, stream.topic)
    (query,) = start_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    await_all([query])
    told = query.lastProgress["observedMetrics"]["batch"]["n_rows"]
    assert told == batches(spark, stream, dim)[0] > 0
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == told


def test_processing_time_trigger(spark, stream, dim, results):
    stream = replace(stream, trigger="200 milliseconds")
    write_topic(results, stream.topic, load_id="1")
    (query,) = start_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    try:
        until = time.time() + 60
        while time.time() < until and not query.lastProgress:
            time.sleep(0.2)
        query.processAllAvailable()
    finally:
        query.stop()
    assert latest(spark, stream, dim) == batch_answer(results, dim)


def test_dimension_is_broadcast_in_the_stream(spark, stream, dim, results):
    write_topic(results, stream.topic)
    (query,) = start_feature_stream(spark, stream, dim, RESULT_MESSAGE)
    await_all([query])
    plan = query._jsq.explainInternal(False)
    assert "BroadcastHashJoin" in plan and "Inner" in plan and "StateStoreSave" in plan
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan


def test_streaming_rules_on_the_lake_fixture(spark, stream):
    bio = spark.createDataFrame(
        [("1", "Male", "180", "80.5"), ("2", "Female", "165.5", "63-65"), ("3", "Male", "nan", "70"),
         ("4", "Female", None, "55"), (None, "Male", "190", "90")],
        "athlete_id string, sex string, height string, weight string",
    )
    rows = spark.createDataFrame(
        [(1, "USA", "Gold", "Figure Skating"), (1, "URS", "Gold", "Figure Skating"), (2, "FRA", "nan", "Judo"),
         (3, "GER", None, "Judo"), (4, "SWE", "Silver", "Judo"), (9, "XXX", "Gold", "Judo"), (None, "ITA", "Gold", "Judo")],
        "athlete_id int, country_noc string, medal string, sport string",
    )
    write_topic(rows, stream.topic)
    run_feature_stream(spark, stream, bio, RESULT_MESSAGE)
    assert latest(spark, stream, bio) == {
        ("Figure Skating", "Gold", "URS", "Male"): (180.0, 80.5),
        ("Figure Skating", "Gold", "USA", "Male"): (180.0, 80.5),
    }


def late_rows(spark, tmp_path, loads):
    """One file and one micro-batch per load, oldest file first."""
    schema, source = "ts timestamp, v double", tmp_path / "in"
    source.mkdir()
    for i, load in enumerate(loads):
        rows = spark.createDataFrame([(f"2024-01-01 {at}:00", float(v)) for at, v in load], "t string, v double")
        rows.selectExpr("t::timestamp AS ts", "v").coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        (file,) = (tmp_path / f"part{i}").glob("*.parquet")
        file.rename(source / f"{i}.parquet")
        os.utime(source / f"{i}.parquet", (1_700_000_000 + 10 * i,) * 2)
    facts = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))
    windows = rolling_averages(facts, "ts", "1 hour", [], ["v"], delay="1 hour")
    query = (
        windows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p["stateOperators"])
    found = spark.read.parquet(str(tmp_path / "out")).select(F.date_format("window_start", "HH:mm"), "avg_v", "n_rows")
    return sorted((at, avg * n, n) for at, avg, n in found.collect()), dropped


def test_late_row_of_the_next_batch_still_counts(spark, tmp_path):
    found, dropped = late_rows(
        spark, tmp_path, [[("00:10", 1)], [("05:00", 2)], [("00:20", 100), ("04:30", 4)], [("09:00", 0)]]
    )
    assert found == [("00:00", 101.0, 2), ("04:00", 4.0, 1), ("05:00", 2.0, 1)] and dropped == 0


def test_row_behind_the_watermark_is_dropped(spark, tmp_path):
    found, dropped = late_rows(
        spark, tmp_path,
        [[("00:10", 1)], [("05:00", 2)], [("05:10", 4)], [("00:20", 100), ("04:30", 8)], [("09:00", 0)]],
    )
    assert found == [("00:00", 1.0, 1), ("04:00", 8.0, 1), ("05:00", 6.0, 2)] and dropped == 1


def test_rolling_features_of_timed_messages(spark, stream, dim, results):
    timed = results.withColumn("timestamp", F.timestamp_seconds(1_700_000_000 + F.col("result_id") * 60))
    write_topic(timed, stream.topic)
    rolling = RollingConfig(size="1 hour", delay="10 minutes")
    schema = run_rolling_stream(spark, stream, rolling, dim, TIMED_RESULT_MESSAGE)
    found = read_history(spark, stream.history, schema)
    joined = timed.join(dim.withColumns({c: F.col(c).try_cast("double") for c in ("height", "weight")}), "athlete_id")
    valid = joined.where(
        "NOT isnan(height) AND NOT isnan(weight) AND sex IS NOT NULL AND medal <> 'nan' AND height + weight IS NOT NULL"
    )
    newest = valid.agg(F.max("timestamp")).first()[0]
    expected = (
        valid.groupBy(F.window("timestamp", "1 hour"), *KEYS).agg(F.avg("height").alias("h"))
        .where(F.col("window.end") <= F.lit(newest) - F.expr("INTERVAL 10 MINUTES"))
        .select("window.start", *KEYS, F.round("h", 6))
    )
    ours = found.select("window_start", *KEYS, F.round("avg_height", 6))
    assert ours.count() == expected.count() > 0 and ours.exceptAll(expected).isEmpty()
