"""Row-wise operators, and duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.functions.numeric import is_number, try_number
from podium.functions.text import NULL_TOKEN, clean_text


def clean_strings(df: DataFrame, null_token: str | None = NULL_TOKEN, keep_spaces: bool = False) -> DataFrame:
    """Clean every plain string column in one projection; other columns pass through."""
    return df.select(
        *(
            clean_text(F.col(f"`{name}`"), null_token, keep_spaces).alias(name)
            if kind == "string"
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        )
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct over all columns. Copies collapse map-side, so a hot group never travels whole."""
    return df.dropDuplicates()


def number_columns(df: DataFrame, columns: Iterable[str], kind: str = "double") -> DataFrame:
    """Replace columns by their tolerant numeric value."""
    return df.withColumns({name: try_number(F.col(name), kind) for name in columns})


def valid_features(
    df: DataFrame,
    measures: Iterable[str] = (),
    required: Iterable[str] = (),
    sentinel_column: str | None = None,
    sentinel: str = "nan",
) -> DataFrame:
    """Keep rows whose measures are numbers, required columns present, and label not the sentinel.

    A missing label is dropped with the sentinel, as SQL comparison does.
    """
    tests = [is_number(F.col(name)) for name in measures]
    tests += [F.col(name).isNotNull() for name in required]
    if sentinel_column:
        tests.append(F.col(sentinel_column) != sentinel)
    return df.where(reduce(and_, tests)) if tests else df


def stamp(df: DataFrame, time_column: str | None) -> DataFrame:
    """Add the processing time, one value per execution or micro-batch."""
    return df.withColumn(time_column, F.current_timestamp()) if time_column else df
