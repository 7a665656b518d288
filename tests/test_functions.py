"""Golden values of the scalar functions."""

from __future__ import annotations

import math
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import (
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from podium.functions import clean_text, is_number, message, parse_messages, try_number
from podium.functions.text import KEPT
from podium.operators import clean_strings, valid_features

NAN = math.nan


@pytest.mark.parametrize(
    ("text", "kind", "expected"),
    [
        ("nan", "double", NAN),
        ("NaN", "double", NAN),
        ("None", "double", None),
        ("", "double", None),
        ("1,85", "double", None),
        (None, "double", None),
        ("Infinity", "double", math.inf),
        ("inf", "double", math.inf),
        ("1e2", "double", 100.0),
        ("185.5", "double", 185.5),
        (" 180 ", "double", 180.0),
        ("180f", "double", 180.0),
        ("180d", "double", 180.0),
        ("19920507", "double", 19920507.0),
        ("19920507", "float", 19920508.0),
    ],
)
def test_try_number(spark, text, kind, expected):
    row = spark.createDataFrame([(text,)], "t string")
    found = row.select(try_number(F.col("t"), kind)).first()[0]
    assert found == expected or (expected is NAN and math.isnan(found))


@pytest.mark.parametrize("kind", ["double", "float"])
def test_try_number_equals_the_cast_without_ansi(spark, kind):
    pick = random.Random(11)
    texts = ["".join(pick.choices("0123456789.,-+eE fdnaNIity_x\t", k=pick.randrange(7))) for _ in range(3000)]
    lenient = spark.newSession()
    lenient.conf.set("spark.sql.ansi.enabled", "false")
    schema = "i int, t string"
    ours = spark.createDataFrame(list(enumerate(texts)), schema).select("i", try_number(F.col("t"), kind))
    theirs = lenient.createDataFrame(list(enumerate(texts)), schema).select("i", F.col("t").cast(kind))
    assert repr(ours.collect()).replace("TRY_", "") == repr(theirs.collect()).replace("TRY_", "")


def test_is_number(spark):
    rows = spark.createDataFrame([(1.0,), (NAN,), (None,), (math.inf,)], "v double")
    assert [r[0] for r in rows.select(is_number(F.col("v"))).collect()] == [True, False, False, True]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("Figure Skating", "FigureSkating"),
        ("José", "Jos"),
        ("63-65", "6365"),
        ("-1", "1"),
        ("a\\b\"c'd", "a\\b\"c'd"),
        ("a\nb\tc", "abc"),
        ("😀ok", "ok"),
        ("", ""),
        (None, "None"),
        ("1992-05-07", "19920507"),
        ("4 × 100", "4100"),
        ("~[]^", ""),
    ],
)
def test_clean_text(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string")
    assert row.select(clean_text(F.col("t"))).first()[0] == expected


def test_clean_text_equals_character_wise_removal(spark):
    pick = random.Random(5)
    alphabet = [chr(c) for c in range(1, 300)] + list("éЖ漢😀𝒳\\\\]]^^--[[&&``") + list(" aZ09,.\"'") * 8
    texts = ["".join(pick.choices(alphabet, k=pick.randrange(40))) for _ in range(3000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    found = dict(rows.select("i", clean_text(F.col("t"))).collect())
    assert found == {i: "".join(c for c in t if c in KEPT) for i, t in enumerate(texts)}


def test_clean_text_options(spark):
    row = spark.createDataFrame([("Figure Skating!", None)], "a string, b string")
    kept = row.select(clean_text(F.col("a"), keep_spaces=True), clean_text(F.col("b"), null_token=None))
    assert tuple(kept.first()) == ("Figure Skating", None)


def test_clean_strings_leaves_other_types(spark):
    rows = spark.createDataFrame(
        [("a b", 1, ["c d"], ("e f",), -2.5)],
        "`s.x` string, i int, l array<string>, t struct<u:string>, d double",
    )
    assert clean_strings(rows).dtypes == rows.dtypes
    found = clean_strings(rows).first()
    assert (found[0], found[1], found[2], found[3][0], found[4]) == ("ab", 1, ["c d"], "e f", -2.5)


MESSAGE = StructType(
    [
        StructField("athlete", StringType()),
        StructField("athlete_id", IntegerType()),
        StructField("isTeamSport", StringType()),
        StructField("medal", StringType()),
    ]
)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ('{"athlete":"A","athlete_id":1,"isTeamSport":false,"medal":"Gold"}', ("A", 1, "false", "Gold")),
        ('{"athlete":"B","athlete_id":"2"}', ("B", None, None, None)),
        ('{"athlete":"C","athlete_id":3.0}', ("C", None, None, None)),
        ('{"athlete":"D","athlete_id":3.5,"medal":"x"}', ("D", None, None, "x")),
        ('{"athlete":"E","athlete_id":99999999999,"medal":"y"}', ("E", None, None, "y")),
        ("not json", (None, None, None, None)),
        ("{}", (None, None, None, None)),
        ('[{"athlete":"A"},{"athlete":"B"}]', (None, None, None, None)),
        ("", (None, None, None, None)),
        (None, (None, None, None, None)),
        ('{"medal":NaN,"athlete_id":5}', (None, 5, None, '"NaN"')),
        ('{"athlete":{"a":1},"athlete_id":5}', ('{"a":1}', 5, None, None)),
        ('{"athlete":"F","more":[1]}', ("F", None, None, None)),
    ],
)
def test_parse_messages(spark, text, expected):
    record = spark.createDataFrame([(None if text is None else text.encode(),)], "value binary")
    assert tuple(parse_messages(record, MESSAGE).first()) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-02T03:04:05.678901Z", "2024-01-02 03:04:05.678901"),
        ("2024-01-02T03:04:05.678901+02:00", "2024-01-02 01:04:05.678901"),
        ("2024-01-02T03:04:05Z", "2024-01-02 03:04:05"),
        ("2024-01-02 03:04:05", "2024-01-02 03:04:05"),
        ("yesterday", None),
    ],
)
def test_message_times(spark, text, expected):
    record = spark.createDataFrame([(f'{{"at":"{text}"}}',)], "value string")
    schema = StructType([StructField("at", TimestampType())])
    assert parse_messages(record, schema).select(F.col("at").cast("string")).first()[0] == expected


def test_local_times_keep_microseconds(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-02 03:04:05.678901' AS at, 1 AS i")
    back = parse_messages(row.select(message().alias("value")), row.schema)
    assert back.exceptAll(row).isEmpty()


def test_message_leaves_out_missing_fields_and_keeps_microseconds(spark):
    row = spark.createDataFrame(
        [(1, None, NAN, datetime(2024, 1, 2, 3, 4, 5, 678901))], "a int, b string, c double, ts timestamp"
    ).withColumn("ts", F.timestamp_micros(F.lit(1704164645678901)))
    expected = '{"a":1,"c":"NaN","ts":"2024-01-02T03:04:05.678901Z"}'
    assert row.select(message()).first()[0] == expected


def test_sentinel(spark):
    labels = [("nan",), ("Gold",), (None,), ("NaN",), ("None",), ("",)]
    rows = spark.createDataFrame(labels, "m string")
    kept = valid_features(rows, sentinel_column="m").collect()
    assert [r.m for r in kept] == ["Gold", "NaN", "None", ""]


def test_valid_features(spark):
    rows = spark.createDataFrame(
        [(1.0, "M"), (NAN, "M"), (None, "M"), (2.0, None), (math.inf, "F")], "h double, sex string"
    )
    kept = valid_features(rows, ["h"], required=["sex"]).collect()
    assert [tuple(r) for r in kept] == [(1.0, "M"), (math.inf, "F")]
    assert valid_features(rows).count() == 5
