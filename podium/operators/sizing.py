"""Measured size of a join side, the proof needed before broadcasting it."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType, StructField

from podium.config import SizingConfig


@dataclass(frozen=True)
class SideProfile:
    rows: int
    bytes: int


# Generous: row header and hash table entry.
_ROW_BYTES = 48


def _width(column: StructField) -> Column:
    value = F.col(f"`{column.name}`")
    if isinstance(column.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(column.dataType, AtomicType):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(value))), F.lit(0)) + 16


def _keyed(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Rows without a key never join."""
    return df.where(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def profile_side(df: DataFrame, keys: Iterable[str]) -> SideProfile:
    """Rows and bytes, in one pass that shuffles nothing but its partial sums."""
    width = reduce(add, (_width(column) for column in df.schema.fields), F.lit(_ROW_BYTES)).cast("long")
    sums = _keyed(df, keys).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return SideProfile(sums["n"], sums["b"] or 0)


def most_rows_per_key(df: DataFrame, keys: Iterable[str]) -> int:
    """Rows of the most frequent key; for sides already measured small."""
    keys = list(keys)
    return _keyed(df, keys).groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def fits_broadcast(profile: SideProfile, sizing: SizingConfig) -> bool:
    return profile.bytes <= sizing.broadcast_bytes


def may_broadcast(
    df: DataFrame, key: str, sizing: SizingConfig, profile: SideProfile | None = None
) -> bool:
    """Whether the side is measured below the limit; a negative limit rules it out unmeasured."""
    if sizing.broadcast_bytes < 0:
        return False
    return fits_broadcast(profile or profile_side(df, [key]), sizing)
