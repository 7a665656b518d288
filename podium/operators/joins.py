"""Enrichment: facts joined with a dimension on one key."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, NumericType, StringType

from podium.config import SizingConfig
from podium.operators.sizing import SideProfile, may_broadcast

SALT = "__salt"
# Candidates that the frequent-key sketch tracks per key it may report.
_TRACKED = 10
# Rows without a key match nothing, so they spread as wide as we like.
_MISSING_PARTS = 1024
_SEED = 17


def hot_keys(facts: DataFrame, key: str, sizing: SizingConfig = SizingConfig()) -> dict[int, list]:
    """Keys holding more than ``hot_share`` of the rows, by the number of parts to split them into.

    Parts are powers of two, enough that each holds at most ``hot_share`` of the rows and ``part_rows``
    rows. One pass and one sketch row of at most ``1 / hot_share`` keys, which Spark limits to shares of
    1e-5 and more; the list only steers salting, never a result.
    """
    if not 1e-5 <= sizing.hot_share <= 1:
        raise ValueError(f"hot_share must lie between 1e-5 and 1: {sizing.hot_share}")
    most = int(1 / sizing.hot_share)
    found = (
        facts.where(F.col(key).isNotNull())
        .agg(
            F.expr(f"approx_top_k(`{key}`, {most}, {most * _TRACKED})").alias("top"),
            F.count(F.lit(1)).alias("n"),
        )
        .first()
    )
    hot: dict[int, list] = {}
    for row in found["top"] or []:
        parts = math.ceil(row["count"] / min(sizing.hot_share * found["n"], sizing.part_rows))
        if parts > 1:
            hot.setdefault(1 << (parts - 1).bit_length(), []).append(row["item"])
    return hot


def align_keys(facts: DataFrame, dim: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Give the key one type. Text meets a number as that number, else NULL, which joins nothing."""
    left, right = facts.schema[key].dataType, dim.schema[key].dataType
    if isinstance(left, StringType) and isinstance(right, NumericType):
        facts = facts.withColumn(key, F.col(key).try_cast(right))
    elif isinstance(right, StringType) and isinstance(left, NumericType):
        dim = dim.withColumn(key, F.col(key).try_cast(left))
    return facts, dim


def keep_one_side(facts: DataFrame, dim: DataFrame, key: str, keep_from: str | None):
    """Drop shared columns from the side that does not provide them, before the join."""
    shared = [c for c in facts.columns if c in dim.columns and c != key]
    if not shared:
        return facts, dim
    if keep_from == "facts":
        return facts, dim.drop(*shared)
    if keep_from == "dim":
        return facts.drop(*shared), dim
    raise ValueError(f"columns on both sides, say keep_from='facts' or 'dim': {shared}")


def _parts(key: str, hot: Mapping[int, Sequence], others: int = 1) -> Column:
    parts = F.when(F.col(key).isNull(), _MISSING_PARTS)
    for count, keys in hot.items():
        parts = parts.when(F.col(key).isin(list(keys)), count)
    return parts.otherwise(others)


def salt_facts(facts: DataFrame, key: str, hot: Mapping[int, Sequence], others: int = 1) -> DataFrame:
    """Deal the rows of hot and missing keys to their parts, the same way when a task is repeated.

    The records of a micro-batch are read in a fixed order, so there a seeded random number serves. In
    a batch the facts may come from a shuffle, whose order is not fixed: rows are sorted within their
    partition and dealt by their place, so that equal rows are spread as well.
    """
    parts = _parts(key, hot, others)
    if facts.isStreaming:
        return facts.withColumn(SALT, F.floor(F.rand(_SEED) * parts).cast("int"))
    rest = [f.name for f in facts.schema.fields if isinstance(f.dataType, AtomicType) and f.name != key]
    ordered = facts.sortWithinPartitions(key, *(F.col(f"`{name}`") for name in rest))
    return ordered.withColumn(SALT, F.pmod(F.xxhash64(F.monotonically_increasing_id()), parts).cast("int"))


def salt_dimension(dim: DataFrame, key: str, hot: Mapping[int, Sequence], others: int = 1) -> DataFrame:
    """Repeat the rows of hot keys once per part."""
    every = F.sequence(F.lit(0), _parts(key, hot, others) - 1)
    return dim.where(F.col(key).isNotNull()).withColumn(SALT, F.explode(every))


def join_salted(
    facts: DataFrame,
    salted: DataFrame,
    key: str,
    hot: Mapping[int, Sequence],
    how: str = "inner",
    others: int = 1,
) -> DataFrame:
    """Shuffled join with a dimension that is salted for the same hot keys.

    The hint keeps compressed file sizes from suggesting a broadcast of a side measured too large. Without
    hot keys, and where missing ones drop out anyway, no salt is needed.
    """
    if how == "inner" and not hot and others == 1:
        return facts.join(salted.drop(SALT).hint("merge"), key)
    return salt_facts(facts, key, hot, others).join(salted.hint("merge"), [key, SALT], how).drop(SALT)


def enrich(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    keep_from: str | None = None,
    sizing: SizingConfig = SizingConfig(),
    profile: SideProfile | None = None,
    hot: Mapping[int, Sequence] | None = None,
) -> DataFrame:
    """Join facts (batch or stream) with a batch dimension; the key appears once.

    A dimension measured below the limit is broadcast and the facts never move. Measuring computes the
    side once more: for one that is itself a large join say so with a negative limit. A larger side is
    shuffled, with the hot keys of the facts salted; a stream cannot be counted, so without ``hot`` all its
    keys are salted over ``stream_parts``.
    Adaptive execution, where it applies, splits what is left of a skewed partition. Select the
    columns you need first: all of them decide the salt.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left': {how}")
    facts, dim = keep_one_side(facts, dim, key, keep_from)
    facts, dim = align_keys(facts, dim, key)
    if may_broadcast(dim, key, sizing, profile):
        return facts.join(F.broadcast(dim), key, how)
    others = sizing.stream_parts if hot is None and facts.isStreaming else 1
    if hot is None:
        hot = {} if facts.isStreaming else hot_keys(facts, key, sizing)
    return join_salted(facts, salt_dimension(dim, key, hot, others), key, hot, how, others)
