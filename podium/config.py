"""Job settings. Every path, column, topic and connection is a parameter.

Secrets never live here: a JDBC user or password is read from the environment variable that the
settings name, or from the Spark session, at the moment of connecting.
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, is_dataclass
from typing import Any, get_args, get_type_hints

BIO_TABLE = "athlete_bio"
RESULTS_TABLE = "athlete_event_results"


@dataclass(frozen=True)
class JdbcConfig:
    url: str
    table: str
    driver: str | None = None
    user_env: str | None = None
    password_env: str | None = None
    # Parallel reads: split on this column, written as in the database's SQL (quotes included where a
    # name needs them). Bounds are looked up when not given.
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    num_partitions: int = 8
    fetch_size: int = 10_000
    batch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def connection(self) -> dict[str, str]:
        found = {"url": self.url, **self.options}
        if self.driver:
            found["driver"] = self.driver
        for name, variable in (("user", self.user_env), ("password", self.password_env)):
            if variable:
                found[name] = os.environ[variable]
        return found


@dataclass(frozen=True)
class TopicConfig:
    """A message topic: Kafka, or a directory of message files on a shared file system.

    ``format`` is ``kafka``, ``parquet`` (key and value columns, as Kafka delivers them) or
    ``text`` (one JSON message per line).
    """

    name: str  # Kafka topic name or directory
    format: str = "parquet"
    starting_offsets: str = "earliest"
    max_per_trigger: int | None = None  # Kafka offsets or files
    tolerate_loss: bool = False
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FeatureConfig:
    """What to join, filter, group and average; shared by batch and stream."""

    key: str = "athlete_id"
    fact_keys: tuple[str, ...] = ("sport", "medal")
    dim_keys: tuple[str, ...] = ("sex", "country_noc")
    fact_measures: tuple[str, ...] = ()
    dim_measures: tuple[str, ...] = ("height", "weight")
    measure_type: str = "float"
    time_column: str | None = "timestamp"

    @property
    def keys(self) -> tuple[str, ...]:
        return self.fact_keys + self.dim_keys

    @property
    def measures(self) -> tuple[str, ...]:
        return self.fact_measures + self.dim_measures


# The stream takes the country from the event, the batch lake from the bio.
STREAM_FEATURES = FeatureConfig(
    fact_keys=("sport", "medal", "country_noc"),
    dim_keys=("sex",),
    measure_type="double",
    time_column="calculated_at",
)


@dataclass(frozen=True)
class SizingConfig:
    """Limits that a side must be measured against before it is broadcast.

    A negative ``broadcast_bytes`` rules a broadcast out without measuring.
    """

    broadcast_bytes: int = 128 * 1024 * 1024
    broadcast_rows_per_key: int = 4
    hot_share: float = 0.001
    part_rows: int = 20_000_000  # rows of one hot key that may meet in a task
    stream_parts: int = 8  # of every key, in a shuffled stream join without a list of hot keys


@dataclass(frozen=True)
class LakeConfig:
    landing: str
    bronze: str
    silver: str
    gold: str
    tables: tuple[str, ...] = (BIO_TABLE, RESULTS_TABLE)
    facts_table: str = RESULTS_TABLE
    dim_table: str = BIO_TABLE
    features: FeatureConfig = field(default_factory=FeatureConfig)
    sizing: SizingConfig = field(default_factory=SizingConfig)
    multi_line: bool = False
    # Layer tables as versions that appear by one rename; read them with read_table.
    versioned: bool = False
    null_token: str | None = "None"
    keep_spaces: bool = False


@dataclass(frozen=True)
class StreamConfig:
    topic: TopicConfig
    checkpoint: str
    history: str
    features: FeatureConfig = STREAM_FEATURES
    sizing: SizingConfig = field(default_factory=SizingConfig)
    sentinel_column: str | None = "medal"
    sentinel: str = "nan"
    required: tuple[str, ...] = ("sex",)
    out_topic: TopicConfig | None = None
    out_table: JdbcConfig | None = None
    snapshot: str | None = None  # complete-mode diagnostic output
    trigger: str | None = None  # e.g. "30 seconds"; None = process what is there, then stop
    snapshot_trigger: str | None = None
    snapshot_versioned: bool = False  # each snapshot as a version that appears by one rename
    compact_every: int | None = None  # batches between compactions of the history
    rejects: str | None = None  # folder for messages that are not whole, with the reason
    # Used where the dimension is broadcast: partitions of the state alone.
    state_partitions: int | None = None
    # Seconds between rounds that take the dimension anew; None keeps its rows as of the start.
    refresh_seconds: float | None = None


@dataclass(frozen=True)
class PublishConfig:
    topic: TopicConfig
    table: JdbcConfig | None = None
    # A key sends all its messages to one Kafka partition: name none that a hot value could fill.
    key_columns: tuple[str, ...] = ()
    load_id: str | None = None


@dataclass(frozen=True)
class RollingConfig:
    """Event-time windows over the rows of a feature stream."""

    event_time: str = "timestamp"
    size: str = "1 day"
    slide: str | None = None
    offset: str | None = None
    delay: str = "1 hour"
    # Sliding windows from partial sums per pane; a checkpoint that was begun without goes on without.
    panes: bool = True


@dataclass(frozen=True)
class ParkingConfig:
    """Messages that wait for their dimension row, in event time.

    ``folder`` holds their versions, ``ready`` is the topic that matched ones go on to.
    """

    folder: str
    ready: TopicConfig
    event_time: str = "timestamp"
    timeout: str = "30 days"


@dataclass(frozen=True)
class StreamJobConfig:
    """A feature stream and where its dimension lives: a database table or a Parquet path."""

    stream: StreamConfig
    dim_table: JdbcConfig | None = None
    dim_path: str | None = None
    rolling: RollingConfig | None = None  # windows instead of averages since the start
    parking: ParkingConfig | None = None  # with refresh_seconds: messages wait for late dimension rows


def from_dict(kind: type, values: dict[str, Any]):
    """Build a (nested) settings object; unknown names are errors."""
    hints = get_type_hints(kind)
    unknown = set(values) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"unknown {kind.__name__} settings: {sorted(unknown)}")
    built = {}
    for name, value in values.items():
        nested = next((t for t in (hints[name], *get_args(hints[name])) if is_dataclass(t)), None)
        if nested and isinstance(value, dict):
            value = from_dict(nested, value)
        elif isinstance(value, list):
            value = tuple(value)
        built[name] = value
    return kind(**built)


def load(kind: type, path: str):
    with open(path, encoding="utf-8") as handle:
        return from_dict(kind, json.load(handle))
