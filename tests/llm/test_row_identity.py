"""Functions that drop or cut: one id on different texts, and null ids, lose no clean text."""

from __future__ import annotations

import pytest
from llm_fixtures import PROSE

from podium.llm import decontaminate, exact_dedup, jaccard_join, line_dedup, paragraph_dedup, url_filter

OTHER = "quite another text about ships in the northern sea and the men who sailed them home again before winter came round"
LONG = "here begins a longer story of its own " + OTHER + " and nobody remembered why the lamps went out one after the other that night"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE), (5, PROSE), (5, OTHER), (None, PROSE), (None, LONG), (7, ""), (7, "short"), (8, None)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, PROSE[:120])], "item_id long, text string")


def kept(frame):
    return sorted([(r.doc_id is None, r.doc_id or 0, r.text or "") for r in frame.collect()])


def rows(*pairs):
    return sorted([(d is None, d or 0, t or "") for d, t in pairs])


def test_exact_copies(docs):
    wanted = rows((1, PROSE), (5, OTHER), (None, LONG), (7, ""), (7, "short"))
    assert kept(exact_dedup.drop_copies(docs)) == wanted


def test_near_copies(docs):
    found = kept(jaccard_join.keep_one(docs))
    assert set(rows((1, PROSE), (5, OTHER), (None, LONG), (7, ""), (7, "short"))) <= set(found)


def test_contaminated(docs, items):
    assert kept(decontaminate.drop_contaminated(docs, items)) == rows((5, OTHER), (None, LONG), (7, ""), (7, "short"), (8, None))


def test_contaminated_in_blocks(docs, items):
    found = decontaminate.drop_contaminated(docs, items, max_windows=1)
    assert kept(found) == rows((5, OTHER), (None, LONG), (7, ""), (7, "short"), (8, None))


def test_cut_spans(docs, items):
    found = kept(decontaminate.remove_spans(docs, items))
    assert {t for _, _, t in found} >= {OTHER, LONG, "", "short"}
    assert sum(PROSE == t for _, _, t in found) == 0 and len(found) == 8


def test_lines_and_passages(docs):
    for function in (line_dedup.drop_lines, paragraph_dedup.remove_passages):
        assert {t for _, _, t in kept(function(docs))} >= {PROSE, OTHER, LONG, "", "short"}


def test_captures(spark):
    captures = spark.createDataFrame(
        [(1, "http://bad.com/x"), (1, "http://good.com/x"), (None, "http://bad.com/y"), (None, "http://good.com/y"), (2, None)],
        "page_id long, url string",
    ).selectExpr("*", "'2024-01-10 00:00:00' AS fetched_at")
    entries = spark.createDataFrame([("bad.com", "2024-01-01 00:00:00", True)], "pattern string, at string, added boolean")
    left = {(r.page_id, r.url) for r in url_filter.drop_listed(captures, entries).collect()}
    assert left == {(1, "http://good.com/x"), (None, "http://good.com/y"), (2, None)}
