"""Joins and averages against brute force, with hot keys on either side or both."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from podium.config import FeatureConfig, SizingConfig
from podium.operators import (
    distinct_rows,
    enrich,
    feature_averages,
    hot_keys,
    joined_averages,
    latest_per_key,
    most_rows_per_key,
    profile_side,
)
from podium.operators.joins import salt_dimension, salt_facts
from podium.operators.aggregates import collapse_dimension, collapsed_averages, weighted_averages

LARGE = SizingConfig(broadcast_bytes=-1)
FEATURES = FeatureConfig(
    key="k",
    fact_keys=("sport",),
    dim_keys=("sex",),
    fact_measures=("points",),
    dim_measures=("height",),
    time_column=None,
)


def _rows(seed: int):
    """A third of the rows of each side share one key; some keys and values are missing or NaN."""
    pick = random.Random(seed)
    value = lambda: pick.choice([None, math.nan, math.inf, *range(1, 40)])
    number = lambda: None if (v := value()) is None else float(v)
    key = lambda: pick.choice([7, None, *range(10), 7, 7, 7, 7])
    facts = [(key(), pick.choice("abc"), number()) for _ in range(400)]
    dim = [(key(), pick.choice("MF"), number()) for _ in range(60)]
    return facts, dim


def _frames(spark, facts, dim):
    return (
        spark.createDataFrame(facts, "k int, sport string, points double"),
        spark.createDataFrame(dim, "k int, sex string, height double"),
    )


def _average(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


def _brute(facts, dim):
    groups = defaultdict(lambda: ([], []))
    for k, sport, points in facts:
        for k2, sex, height in dim:
            if k is not None and k == k2:
                groups[sport, sex][0].append(points)
                groups[sport, sex][1].append(height)
    return {g: (_average(p), _average(h)) for g, (p, h) in groups.items()}


def _same(found, expected):
    found = {(r.sport, r.sex): (r.avg_points, r.avg_height) for r in found.collect()}
    assert found.keys() == expected.keys()
    for group, values in expected.items():
        for ours, theirs in zip(found[group], values, strict=True):
            if theirs is None or math.isnan(theirs):
                assert ours is None if theirs is None else math.isnan(ours)
            else:
                assert ours == pytest.approx(theirs)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "sizing",
    [SizingConfig(broadcast_rows_per_key=1000), SizingConfig(), SizingConfig(broadcast_rows_per_key=1), LARGE],
    ids=["few rows per key", "few groups per key", "many groups per key", "large"],
)
def test_joined_averages(spark, seed, sizing):
    facts, dim = _rows(seed)
    frames = _frames(spark, facts, dim)
    _same(joined_averages(*frames, FEATURES, sizing), _brute(facts, dim))


def test_joined_averages_of_all_missing_values(spark):
    facts, dim = [(1, "a", None)], [(1, "M", None)]
    for sizing in (SizingConfig(), LARGE):
        found = joined_averages(*_frames(spark, facts, dim), FEATURES, sizing).first()
        assert (found.avg_points, found.avg_height) == (None, None)


def test_weighted_counts_do_not_overflow(spark):
    rows = spark.createDataFrame([("a", "M", 4 * 10**12, 2.0)], "sport string, sex string, n long, v double")
    n = F.col("n")
    weights = {"v": (DoubleType(), F.col("v") * n, n, n)}
    assert weighted_averages(rows, ["sport", "sex"], weights).first().avg_v == 2.0


def test_collapsed_dimension_gives_the_joined_averages(spark):
    facts, dim = _rows(3)
    facts = [f for f in facts if f[2] is not None]
    fact_rows, dim_rows = _frames(spark, facts, dim)
    joined = enrich(fact_rows, collapse_dimension(dim_rows, FEATURES), "k")
    _same(collapsed_averages(joined, FEATURES), _brute(facts, dim))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, how):
    facts, dim = _frames(spark, *_rows(4))
    columns = ["k", "sport", "points", "sex", "height"]
    plain = facts.join(dim, "k", how).select(columns)
    salted = enrich(facts, dim, "k", how, sizing=LARGE).select(columns)
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_hot_rows_spread_evenly_and_repeatably(spark):
    facts = spark.range(20000).select(F.lit(7).alias("k"), "id", F.lit(None).cast("map<int,int>").alias("m"))
    dim = spark.createDataFrame([(7, "M"), (8, "F"), (None, "F")], "k int, sex string")
    sizes = []
    for partitions in (1, 5):
        salted = salt_facts(facts.repartition(partitions), "k", {16: [7]})
        repeated = salt_dimension(dim, "k", {16: [7]})
        rows = salted.groupBy("__salt").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"))
        sizes.append({r["__salt"]: (r.n, r.s) for r in rows.collect()})
        assert sizes[-1] == {r["__salt"]: (r.n, r.s) for r in rows.collect()}
        assert set(sizes[-1]) == set(range(16))
        assert max(n for n, _ in sizes[-1].values()) < 1.2 * 20000 / 16
        assert repeated.groupBy("k").count().orderBy("k").collect() == [(7, 16), (8, 1)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equal_hot_rows_spread(spark, how):
    facts = spark.range(40000).select(F.when(F.col("id") % 2 == 0, 7 if how == "inner" else None).otherwise(F.col("id")).alias("k"))
    salted = salt_facts(facts.repartition(4, "k"), "k", {64: [7]})
    spread = salted.where("k = 7 or k is null").groupBy("k", "__salt").count().select("count")
    counts = sorted(r["count"] for r in spread.collect())
    assert counts[-1] <= 2 * counts[len(counts) // 2]


def test_hot_share_is_checked(spark):
    with pytest.raises(ValueError, match="hot_share"):
        hot_keys(spark.range(3), "id", SizingConfig(hot_share=1e-6))


def test_hot_keys_are_split_by_rows(spark):
    facts = spark.range(1000).select((F.col("id") % 2).alias("k"))
    assert hot_keys(facts, "k", SizingConfig(hot_share=0.4, part_rows=100)) == {8: [0, 1]} or hot_keys(
        facts, "k", SizingConfig(hot_share=0.4, part_rows=100)
    ) == {8: [1, 0]}


@pytest.mark.parametrize("kind", ["decimal(12,2)", "decimal(20,4)", "double", "float"])
def test_averages_have_one_type(spark, kind):
    facts = spark.range(60).selectExpr("id % 7 AS k", f"cast(id / 3.0 AS {kind}) AS x", "id % 2 AS a")
    dim = spark.range(7).selectExpr("id AS k", f"cast(id / 7.0 AS {kind}) AS y", "id % 3 AS b")
    dim = dim.union(dim)
    f = FeatureConfig("k", ("a",), ("b",), ("x",), ("y",), kind, None)
    plans = (SizingConfig(), SizingConfig(broadcast_rows_per_key=1), SizingConfig(broadcast_bytes=-1))
    found = [joined_averages(facts, dim, f, sizing) for sizing in plans]
    assert len({str(frame.schema) for frame in found}) == 1
    rows = [sorted(map(tuple, frame.collect())) for frame in found]
    if kind.startswith("decimal"):
        assert rows[0] == rows[1] == rows[2]
    else:
        for other in rows[1:]:
            assert all(a == pytest.approx(b) for a, b in zip(rows[0], other))


def test_hot_keys_follow_the_share(spark):
    facts = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id")).alias("k")
    )
    assert hot_keys(facts, "k", replace(LARGE, hot_share=0.01)) == {64: [0]}
    assert hot_keys(facts.where("k > 0"), "k", replace(LARGE, hot_share=0.01)) == {}
    assert hot_keys(facts.where("k < 0"), "k") == {}


def test_profile_counts_keyed_rows(spark):
    dim = spark.createDataFrame([(1, "ab"), (1, None), (2, "c"), (None, "d")], "k int, t string")
    profile = profile_side(dim, ["k"])
    assert (profile.rows, profile.bytes) == (3, 3 * (48 + 32) + 3)
    assert most_rows_per_key(dim, ["k"]) == 2
    none = dim.where("k > 5")
    assert (profile_side(none, ["k"]).bytes, most_rows_per_key(none, ["k"])) == (0, 0)


def test_complex_columns_are_measured(spark):
    dim = spark.createDataFrame([(1, [1, 2], {"a": "b"})], "k int, l array<int>, m map<string,string>")
    assert profile_side(dim, ["k"]).bytes > 48 + 48


def test_shared_columns_need_a_side(spark):
    facts = spark.createDataFrame([(1, "USA")], "k int, country string")
    dim = spark.createDataFrame([(1, "URS", 2.0)], "k int, country string, h double")
    with pytest.raises(ValueError, match="country"):
        enrich(facts, dim, "k")
    assert enrich(facts, dim, "k", keep_from="facts").first().country == "USA"
    assert enrich(facts, dim, "k", keep_from="dim").first().country == "URS"


@pytest.mark.parametrize("how", ["right", "outer", "cross"])
def test_other_joins_are_refused(spark, how):
    facts, dim = _frames(spark, [(1, "a", 1.0)], [(1, "M", 1.0)])
    with pytest.raises(ValueError, match="how"):
        enrich(facts, dim, "k", how)


def test_text_and_number_keys(spark):
    facts = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c")], "k string, v string")
    dim = spark.createDataFrame([(1, 2.0)], "k bigint, h double")
    assert [r.v for r in enrich(facts, dim, "k").collect()] == ["a"]
    left = enrich(facts, dim, "k", "left").orderBy("v").collect()
    assert [(r.k, r.h) for r in left] == [(1, 2.0), (None, None), (None, None)]
    assert enrich(dim, facts, "k").count() == 1


def test_distinct_treats_nan_zero_and_null_as_equal(spark):
    rows = spark.createDataFrame(
        [(math.nan, None), (math.nan, None), (0.0, "a"), (-0.0, "a")], "d double, s string"
    )
    assert distinct_rows(rows).count() == 2


def test_plain_averages(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", None), ("a", math.nan), ("b", None)], "k string, v double")
    found = {r.k: r.avg_v for r in feature_averages(rows, ["k"], ["v"], "at").drop("at").collect()}
    assert math.isnan(found["a"]) and found["b"] is None


def test_float_averages_are_not_double_averages(spark):
    rows = spark.createDataFrame([("a", "1.1"), ("a", "2.2")], "k string, v string")
    found = feature_averages(rows.withColumn("v", F.col("v").try_cast("float")), ["k"], ["v"]).first()
    assert found.avg_v == 1.6500000357627869


def test_latest_ignores_repeated_rows(spark):
    rows = [("a", 1.0, 0), ("a", 2.0, 1), ("a", 2.0, 1), (None, 3.0, 0)]
    history = spark.createDataFrame(rows, "k string, v double, batch_id long")
    found = {r.k: (r.v, r.batch_id) for r in latest_per_key(history, ["k"]).collect()}
    assert found == {"a": (2.0, 1), None: (3.0, 0)}
