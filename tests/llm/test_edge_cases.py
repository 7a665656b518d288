"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names, for each operator."""

from __future__ import annotations

import hashlib

import pytest
from llm_fixtures import HARD, PROSE
from pyspark.sql import functions as F

from podium.llm import (
    byte_bpe, decontaminate, exact_dedup, jaccard_join, language, line_dedup, paragraph_dedup, quality, secret_scan,
    url_filter,
)
from podium.llm.queries import ranks_path, split_pattern

IDS = sorted([*(row[0] for row in HARD), 1])


def by_id(frame, id_col="doc_id"):
    return {row[id_col]: row for row in frame.collect()}


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the old mill and the children watched the boats drift"), (2, None), (3, ""), (None, "word word"), (4, "日本語のテキスト"), (5, "the old mill and the children watched the boats drift")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (7, 0), (8, 0), (12, 1), (4, 1), (None, 1), (2, None), (99, 0)], "doc_id long, quality int")


def operators(docs, items, labels):
    """Each operator over the same documents, as (rows, one row per document or not)."""
    yield secret_scan.scan(docs, secret_scan.train(docs))
    yield line_dedup.repeated_lines(docs)
    yield byte_bpe.decode(byte_bpe.encode(docs, ranks_path(), split_pattern()), ranks_path())
    yield jaccard_join.similarity_classes(docs)
    yield exact_dedup.exact_groups(docs)
    yield decontaminate.contamination(docs, items)
    yield quality.score(docs, quality.train(docs, labels))
    yield language.predict(docs, language.train(docs, F.lit(True)))
    yield paragraph_dedup.repeated_passages(docs)


def test_one_row_per_document(hard, items, labels):
    for found in operators(hard, items, labels):
        assert sorted(r["doc_id"] for r in found.select("doc_id").collect()) == IDS


def test_empty_tables(empty, items, labels):
    for found in operators(empty, items.limit(0), labels.limit(0)):
        assert found.collect() == []


def test_stage_functions_keep_columns(hard, items):
    kept = [
        language.drop_rejected(hard, language.train(hard, F.lit(True))),
        exact_dedup.drop_copies(hard),
        jaccard_join.keep_one(hard),
        decontaminate.drop_contaminated(hard, items),
        decontaminate.remove_spans(hard, items),
        line_dedup.drop_lines(hard),
        paragraph_dedup.remove_passages(hard),
    ]
    for frame in kept:
        assert frame.columns == hard.columns
        assert frame.dtypes == hard.dtypes
        frame.collect()


def test_secrets(hard):
    found = by_id(secret_scan.scan(hard, secret_scan.train(hard)))
    assert found[4]["spans"] == found[5]["spans"] == []
    assert [(s["kind"], s["start"], s["end"]) for s in found[13]["spans"]] == [("assign", 0, 49), ("hex", 9, 49)]


def test_tokens(hard):
    ids = byte_bpe.encode(hard, ranks_path(), split_pattern())
    found = by_id(byte_bpe.decode(ids, ranks_path()))
    assert by_id(byte_bpe.round_trip(hard, ranks_path(), split_pattern())) == found
    for doc_id, text, _ in HARD:
        assert found[doc_id]["decoded"] == (text or "").encode()
        assert found[doc_id]["well_formed"]
    assert found[4]["n_tokens"] == found[5]["n_tokens"] == 0


def test_exact_groups(hard):
    found = by_id(exact_dedup.exact_groups(hard))
    assert [(found[k]["keep_id"], found[k]["group_size"], found[k]["kept"]) for k in (1, 2, 4, 5, 6)] == [
        (1, 3, True), (1, 3, False), (4, 2, True), (4, 2, False), (6, 1, True),
    ]
    assert found[6]["text_sha256"] == hashlib.sha256(b" ").hexdigest()


def test_jaccard_classes(hard):
    found = by_id(jaccard_join.similarity_classes(hard))
    assert [found[k]["class_id"] for k in (1, 2, 4, 5, 7, 8, 12, 14)] == [1, 1, 4, 5, 7, 8, 12, 1]
    assert (found[1]["n_copies"], found[4]["n_links"]) == (3, 0)


def test_contamination(hard, items):
    found = by_id(decontaminate.contamination(hard, items))
    assert found[1]["items"] == ["1", "5"]
    assert found[10]["items"] == ["4"]
    assert found[4]["n_words"] == found[5]["n_words"] == found[6]["n_words"] == 0
    assert found[12]["items"] == [] and found[8]["n_words"] == 40_000
    assert len(found[14]["hit_from"]) == 2


def test_contamination_beyond_the_broadcast_limit(hard, items):
    few = decontaminate.contamination(hard.dropDuplicates(["doc_id"]), items, max_windows=1)
    all_ = decontaminate.contamination(hard.dropDuplicates(["doc_id"]), items)
    assert {r["doc_id"]: tuple(map(str, r)) for r in few.collect()} == {r["doc_id"]: tuple(map(str, r)) for r in all_.collect()}


def test_contamination_in_blocks_keeps_every_row(spark, hard, items):
    """Repeated rows, null ids, and different texts of as many words under one id."""
    passage = "the old mill and the children watched the boats drift"
    rows = [(None, passage), (None, passage), (None, passage.replace("old", "new")), (50, passage), (50, passage.upper()), (50, passage.replace("mill", "barn"))]
    docs = hard.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    more = items.union(spark.createDataFrame([(100 + k, passage) for k in range(6)], items.schema))
    few, all_ = (sorted(map(str, decontaminate.contamination(docs, more, max_windows=n).collect())) for n in (2, 1_000))
    assert len(few) == len(IDS) + 6
    assert few == all_


def test_blocks_are_bounded_by_pairs(spark, hard, items, monkeypatch):
    sizes = []
    lookup = decontaminate._scanner

    def seen(spark, windows):
        sizes.append(windows.count())
        return lookup(spark, windows)

    monkeypatch.setattr(decontaminate, "_scanner", seen)
    same = spark.createDataFrame([(k, "the old mill and the children watched the boats drift") for k in range(200)], items.schema)
    decontaminate.contamination(hard, same, max_windows=50)
    assert len(sizes) == 4 and sum(sizes) == 200 and max(sizes) <= 80


def test_removed_spans(hard, items):
    cut = by_id(decontaminate.remove_spans(hard, items))
    assert cut[1]["text"] == PROSE.replace("the old mill and the children watched the boats drift", " ")
    assert cut[4]["text"] is None and cut[5]["text"] == ""


def test_language(hard):
    found = by_id(language.predict(hard, language.train(hard, F.lit(True))))
    for k in (4, 5, 6, 7):
        assert (found[k]["lang_pred"], found[k]["score"], found[k]["accepted"]) == ("und", 0.0, False)
    assert found[10]["lang_pred"] != "und"
    unlearned = by_id(language.predict(hard, language.train(hard, F.lit(False))))
    assert unlearned[1]["lang_pred"] == "und" and unlearned[1]["accepted"] and not unlearned[4]["accepted"]


def test_quality_without_labels(hard, labels):
    found = by_id(quality.score(hard, quality.train(hard, labels.limit(0))))
    assert {r["score"] for r in found.values()} == {0.5} and {r["predicted"] for r in found.values()} == {1}


def test_lines(hard):
    found = by_id(line_dedup.repeated_lines(hard))
    assert (found[2]["dropped"], found[2]["kept_in"]) == ([0], [1])
    assert found[14]["dropped"] == [0, 1] and found[4]["n_dropped"] == found[5]["n_dropped"] == 0


def test_passages(hard):
    found = by_id(paragraph_dedup.repeated_passages(hard))
    assert found[2]["kept_in"] == [1] and found[2]["n_removed"] == 30
    assert found[14]["n_removed"] == 60
    assert found[4]["n_removed"] == found[5]["n_removed"] == found[8]["n_removed"] == 0


def test_url_lists(spark):
    captures = spark.createDataFrame(
        [
            (1, "https://User@Sub.Example.com:80/en/x?q#f", "2024-01-10 00:00:00"),
            (2, "https://sub.example.com/en", "2024-01-20 00:00:00"),
            (3, None, "2024-01-10 00:00:00"),
            (4, "not a url", "2024-01-10 00:00:00"),
            (5, "http://example.org", None),
            (6, "http://notexample.com/", "2024-01-10 00:00:00"),
            (7, "http://example.com/english", "2024-01-30 00:00:00"),
            (7, "http://example.com/english", "2024-01-30 00:00:00"),
        ],
        "page_id long, url string, fetched_at string",
    ).withColumn("entries", F.lit(1))
    changes = spark.createDataFrame(
        [
            ("example.com", "2024-01-05 00:00:00", True),
            ("example.com", "2024-01-20 00:00:00", False),
            ("example.com", "2024-01-20 00:00:00", True),
            ("example.com/en", "2024-01-10 00:00:00", True),
            ("example.org", "2024-01-01 00:00:00", True),
            (None, "2024-01-01 00:00:00", True),
            ("com", None, True),
        ],
        "pattern string, at string, added boolean",
    )
    found = by_id(url_filter.listed(captures, changes), "page_id")
    assert {k: r["entries"] for k, r in found.items()} == {
        1: ["example.com", "example.com/en"], 2: ["example.com/en"], 3: [], 4: [], 5: [], 6: [], 7: [],
    }
    assert (found[1]["host"], found[3]["host"], found[4]["host"]) == ("sub.example.com", None, None)
    assert url_filter.listed(captures, changes).count() == 8
    assert url_filter.listed(captures.limit(0), changes).count() == 0
    assert url_filter.listed(captures, changes.limit(0)).where("listed").count() == 0
    assert url_filter.drop_listed(captures, changes).columns == captures.columns


def test_url_lists_of_any_depth(spark):
    captures = spark.createDataFrame(
        [(1, "https://a.b.c.d.e.f.example.com/x/y/z/w?q"), (2, "https://example.com/x/y"), (3, "https://b.c.d.e.f.example.com/")],
        "page_id long, url string",
    ).withColumn("fetched_at", F.lit("2024-01-10 00:00:00"))
    patterns = ["example.com/x/y/z", "example.com/x/y/z/w/v", "b.c.d.e.f.example.com", "e.f.example.com/x/y/z/w"]
    changes = spark.createDataFrame([(p, "2024-01-05 00:00:00", True) for p in patterns], "pattern string, at string, added boolean")
    found = {r["page_id"]: r["entries"] for r in url_filter.listed(captures, changes).collect()}
    assert found == {1: ["b.c.d.e.f.example.com", "e.f.example.com/x/y/z/w", "example.com/x/y/z"], 2: [], 3: ["b.c.d.e.f.example.com"]}
