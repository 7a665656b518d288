"""Registered queries over the given tables, each with its SQL counterpart where SQL can say it."""

from podium.catalog import athletes, gold, messages, silver, streams, tables
from podium.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "athletes", "gold", "messages", "silver", "streams", "tables"]
