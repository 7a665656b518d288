"""Fixtures of the operator tests."""

from __future__ import annotations

import pytest
from llm_fixtures import HARD

from podium.llm.work import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def hard(spark):
    """Hard texts with nulls, a repeated row, and further columns whose names the operators use themselves."""
    rows = [(*row, "s", None, 7, "x", [1]) for row in [*HARD, HARD[0]]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id long, ids string, spans array<int>"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.where("doc_id < 0")
