"""Micro-batch fan-out to several sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from podium.sinks.history import read_batch, write_batch

Sink = Callable[[DataFrame, int], None]


class SinkFailure(RuntimeError):
    """One or more sinks refused a micro-batch; the batch is not committed and will be replayed."""


@dataclass(frozen=True)
class FanOut:
    """``foreachBatch`` callback.

    The batch is computed once and stored in the history, which also lets it survive lost executors; a
    replayed batch that was stored whole before is taken from there, so that all sinks agree on it.
    Every sink reads that stored copy and is tried even when another one fails; then failures raise.
    """

    history: str
    sinks: Mapping[str, Sink]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, self.history, batch_id)
        if not self.sinks:
            return
        stored = read_batch(batch.sparkSession, self.history, batch_id)
        if stored.isEmpty():
            return
        failures = {}
        for name, sink in self.sinks.items():
            try:
                sink(stored, batch_id)
            except Exception as error:  # noqa: BLE001 - reported below, after the other sinks
                failures[name] = error
        if failures:
            told = "; ".join(f"{name}: {error}" for name, error in failures.items())
            raise SinkFailure(f"batch {batch_id}: {told}") from next(iter(failures.values()))
