"""Feature averages, plain, over a join, rolling, and the latest row per key."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType

from podium.config import FeatureConfig, SizingConfig
from podium.operators.joins import align_keys
from podium.operators.rows import stamp
from podium.operators.sizing import SideProfile, may_broadcast, most_rows_per_key

_ROWS = "__rows"


def _sum(measure: str) -> str:
    return f"__sum_{measure}"


def _count(measure: str) -> str:
    return f"__count_{measure}"


def _averages(measures: Iterable[str]) -> list[Column]:
    return [F.avg(m).alias(f"avg_{m}") for m in measures]


def _processing_time(time_column: str | None) -> list[Column]:
    return [F.current_timestamp().alias(time_column)] if time_column else []


def feature_averages(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], time_column: str | None = None
) -> DataFrame:
    """Average of every measure per key group, batch or stream."""
    return df.groupBy(*keys).agg(*_averages(measures), *_processing_time(time_column))


def _summed(measure: str, kind: DataType) -> Column:
    """The measure as it is summed: decimals exactly, everything else as double."""
    return F.col(measure) if isinstance(kind, DecimalType) else F.col(measure).cast("double")


def collapse(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per key group: row count, and sum and count of each measure."""
    parts = [F.count(F.lit(1)).alias(_ROWS)]
    for m in measures:
        parts += [F.sum(_summed(m, df.schema[m].dataType)).alias(_sum(m)), F.count(m).alias(_count(m))]
    return df.groupBy(*keys).agg(*parts)


def _partials(kind: DataType, total: Column, count: Column, weight: Column) -> tuple[Column, Column]:
    """Sum and count as aggregates, in one arithmetic whatever the rows were collapsed to before.

    ``kind`` is the type of the measure. Decimals are summed exactly, so that the way of joining cannot show;
    weights must leave room in 38 digits. Other numbers are doubles: products of counts may leave the range
    of long.
    """
    if not isinstance(kind, DecimalType):
        return F.sum(total * weight), F.sum(count.cast("double") * weight)
    digits = 38 - 1 - (kind.precision + 10)
    if digits < 6:
        raise ValueError(f"averages take decimals of at most 21 digits: {kind.simpleString()}")
    weight = weight.cast(DecimalType(digits, 0))
    total = total.cast(DecimalType(kind.precision + 10, kind.scale))
    return F.sum(total * weight), F.sum(count.cast(DecimalType(20, 0)) * weight.cast(DecimalType(min(digits, 17), 0)))


def _quotient(kind: DataType, total: Column, count: Column) -> Column:
    if not isinstance(kind, DecimalType):
        return F.try_divide(total, count)
    result = DecimalType(kind.precision + 4, min(kind.scale + 4, kind.precision + 4))
    return F.try_divide(total, count.cast(DecimalType(20, 0))).cast(result)


def _average(kind: DataType, total: Column, count: Column, weight: Column) -> Column:
    return _quotient(kind, *_partials(kind, total, count, weight))


def weighted_averages(
    df: DataFrame,
    keys: Sequence[str | Column],
    weights: dict[str, tuple[DataType, Column, Column, Column]],
    time_column: str | None = None,
) -> DataFrame:
    """Averages from (type, sum, count, weight) per measure; a group without values averages to NULL."""
    return df.groupBy(*keys).agg(
        *(_average(*parts).alias(f"avg_{m}") for m, parts in weights.items()),
        *_processing_time(time_column),
    )


def joined_averages(
    facts: DataFrame,
    dim: DataFrame,
    features: FeatureConfig,
    sizing: SizingConfig = SizingConfig(),
    profile: SideProfile | None = None,
) -> DataFrame:
    """Averages over ``facts`` inner-joined with ``dim``.

    A dimension that is measured small, with few rows or groups per key, is broadcast: the facts are
    averaged where they lie and only partial sums are shuffled. Otherwise both sides are first
    collapsed to one row per join key and group, so that a key held by many rows on either side, or on
    both, meets as a few weighted rows and its pairs are never formed. Types and arithmetic of the
    averages are the same in each case.
    """
    f = features
    facts = facts.select(f.key, *f.fact_keys, *f.fact_measures)
    dim = dim.select(f.key, *f.dim_keys, *f.dim_measures)
    facts, dim = align_keys(facts, dim, f.key)
    kinds = {m: facts.schema[m].dataType for m in f.fact_measures}
    kinds |= {m: dim.schema[m].dataType for m in f.dim_measures}
    small = may_broadcast(dim, f.key, sizing, profile)
    if small and most_rows_per_key(dim, [f.key]) <= sizing.broadcast_rows_per_key:
        joined = facts.join(F.broadcast(dim), f.key)
        plain = {
            m: (kinds[m], _summed(m, kinds[m]), F.col(m).isNotNull().cast("int"), F.lit(1)) for m in f.measures
        }
        return stamp(weighted_averages(joined, f.keys, plain), f.time_column)
    groups = dim.select(f.key, *f.dim_keys).distinct()
    if small and most_rows_per_key(groups, [f.key]) <= sizing.broadcast_rows_per_key:
        joined = facts.join(F.broadcast(collapse_dimension(dim, f)), f.key)
        return stamp(collapsed_averages(joined, f), f.time_column)

    left = collapse(facts.where(F.col(f.key).isNotNull()), [f.key, *f.fact_keys], f.fact_measures)
    right = collapse(dim.where(F.col(f.key).isNotNull()), [f.key, *f.dim_keys], f.dim_measures)
    left = left.withColumnRenamed(_ROWS, "__left")
    right = right.withColumnRenamed(_ROWS, "__right")
    weights = {m: (kinds[m], F.col(_sum(m)), F.col(_count(m)), F.col("__right")) for m in f.fact_measures}
    weights |= {m: (kinds[m], F.col(_sum(m)), F.col(_count(m)), F.col("__left")) for m in f.dim_measures}
    if not small:
        right = right.hint("merge")
    # Bounded per key by its groups, so this join needs no salting.
    return stamp(weighted_averages(left.join(right, f.key), f.keys, weights), f.time_column)


def collapse_dimension(dim: DataFrame, features: FeatureConfig) -> DataFrame:
    """Dimension rows of one key and group merged into one weighted row, for stream enrichment."""
    return collapse(dim, [features.key, *features.dim_keys], features.dim_measures)


def _collapsed_weights(joined: DataFrame, features: FeatureConfig) -> dict[str, tuple[DataType, Column, Column, Column]]:
    weights = {}
    for m in features.fact_measures:
        kind = joined.schema[m].dataType
        weights[m] = (kind, _summed(m, kind), F.col(m).isNotNull().cast("int"), F.col(_ROWS))
    for m in features.dim_measures:
        kind = joined.schema[_sum(m)].dataType
        if isinstance(kind, DecimalType):
            kind = DecimalType(kind.precision - 10, kind.scale)  # a sum has ten digits more
        weights[m] = (kind, F.col(_sum(m)), F.col(_count(m)), F.lit(1))
    return weights


def collapsed_averages(
    joined: DataFrame,
    features: FeatureConfig,
    time_column: str | None = None,
    window: Column | None = None,
) -> DataFrame:
    """Averages of rows enriched with a collapsed dimension, batch or stream, per window if given."""
    keys = [*features.keys] if window is None else [window.alias("window"), *features.keys]
    return weighted_averages(joined, keys, _collapsed_weights(joined, features), time_column)


def pane_length(spark: SparkSession, *lengths: str) -> tuple[str, bool]:
    """The greatest length that divides all these intervals, and whether it is shorter than the first of them."""
    shown = ", ".join(f"unix_micros(timestamp_micros(0) + INTERVAL {text})" for text in lengths)
    micros = spark.sql(f"SELECT {shown}").first()
    pane = math.gcd(*micros)
    return f"{pane} microseconds", pane < micros[0]


def paned_averages(
    df: DataFrame,
    event_time: str,
    size: str,
    slide: str,
    offset: str | None,
    keys: Sequence[str],
    weights: dict[str, tuple[DataType, Column, Column, Column]],
    time_column: str | None = None,
    rows: str | None = None,
) -> DataFrame:
    """Averages per sliding window from partial sums per pane.

    A row counts in one pane, as long as the greatest common divisor of size and slide; only panes, one row per
    group, are copied to the windows that hold them. In a stream both steps keep state, in append mode. ``rows`` names a
    column for the number of rows, which plain rows have.
    """
    pane, _ = pane_length(df.sparkSession, size, slide)
    parts = [F.count(F.lit(1)).alias(_ROWS)]
    for m, (kind, total, count, weight) in weights.items():
        total, count = _partials(kind, total, count, weight)
        parts += [total.alias(_sum(m)), count.alias(_count(m))]
    panes = df.groupBy(F.window(event_time, pane, pane, offset).alias("pane"), *keys).agg(*parts)
    windows = panes.groupBy(F.window("pane", size, slide, offset).alias("window"), *keys)
    totals = {m: (kind, F.sum(_sum(m)), F.sum(_count(m))) for m, (kind, *_) in weights.items()}
    if rows:
        # Rows that were not collapsed before: decimals are divided in the type of their plain sum, as avg does.
        for m, (kind, total, count) in totals.items():
            if isinstance(kind, DecimalType):
                totals[m] = (kind, total.cast(DecimalType(min(kind.precision + 10, 38), kind.scale)), count)
    return windows.agg(
        *(_quotient(*parts).alias(f"avg_{m}") for m, parts in totals.items()),
        *([F.sum(_ROWS).alias(rows)] if rows else []),
        *_processing_time(time_column),
    )


def collapsed_windows(
    joined: DataFrame,
    features: FeatureConfig,
    event_time: str,
    size: str,
    slide: str | None,
    offset: str | None,
    time_column: str | None = None,
    panes: bool = True,
) -> DataFrame:
    """Averages per event-time window of rows enriched with a collapsed dimension, sliding ones from panes."""
    slide = slide or size
    if panes and pane_length(joined.sparkSession, size, slide)[1]:
        weights = _collapsed_weights(joined, features)
        return paned_averages(joined, event_time, size, slide, offset, features.keys, weights, time_column)
    return collapsed_averages(joined, features, time_column, F.window(event_time, size, slide, offset))


def window_bounds(df: DataFrame) -> DataFrame:
    """The window column as its two bounds."""
    rest = [c for c in df.columns if c != "window"]
    return df.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def rolling_averages(
    df: DataFrame,
    event_time: str,
    size: str,
    keys: Sequence[str],
    measures: Sequence[str],
    slide: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Averages per event-time window. With ``delay`` a stream waits that long for late rows.

    Sliding windows of a batch are put together from panes; a stream, whose output mode is not known here, copies its rows.
    """
    if delay:
        df = df.withWatermark(event_time, delay)
    slide = slide or size
    if not df.isStreaming and pane_length(df.sparkSession, size, slide)[1]:
        kinds = {m: df.schema[m].dataType for m in measures}
        weights = {m: (k, _summed(m, k), F.col(m).isNotNull().cast("int"), F.lit(1)) for m, k in kinds.items()}
        return window_bounds(paned_averages(df, event_time, size, slide, None, keys, weights, rows="n_rows"))
    window = F.window(event_time, size, slide).alias("window")
    averaged = df.groupBy(window, *keys).agg(*_averages(measures), F.count(F.lit(1)).alias("n_rows"))
    return window_bounds(averaged)


def latest_per_key(history: DataFrame, keys: Sequence[str], order: str = "batch_id") -> DataFrame:
    """Newest history row of every key group; repeated rows change nothing."""
    rest = [c for c in history.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.col(order)).alias("newest")
    return history.groupBy(*keys).agg(newest).select(*keys, "newest.*")
