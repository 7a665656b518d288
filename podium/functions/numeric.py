"""Tolerant numbers: text that is no number becomes NULL, also under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_number(value: Column, kind: str = "double") -> Column:
    return value.try_cast(kind)


def is_number(value: Column) -> Column:
    """Neither missing nor NaN; infinities count as numbers."""
    return value.isNotNull() & ~F.isnan(value)
