"""Substring dedup: passages that repeat within or across documents, by paragraphs.

Two kinds of paragraph cover a text. **Lines** of ``MIN_WORDS`` words or more are compared by similarity;
**segments** find passages wherever they stand: a text is cut where the hash of a pair of words is the least
among ``RADIUS`` places on either side, so that equal passages are cut alike whatever surrounds them (some 9
words apart; a passage of 51 words keeps 16 or more within its cuts in 995 of 1000 cases, one of 60 words
nearly always).

Lines become sets of word 5-gram hashes with MinHash sketches. Equal sets are one paragraph. The number of
bands is tuned: the fewest keys that bring two sets of similarity ``threshold`` together with chance
``recall``. Sets that share a band are pointed to the least of them (no pairs are formed), components of these
links are the candidate clusters, and each cluster's sets, computed once more from the texts, are
compared exactly (``clusters``); components of the verified links are the classes. Two segments of
a few words are that similar only if they are equal, so their digest (96 bits and the length) is their only band.

In each class the earliest paragraph, by document id and then by place, stays. All others are removed: a line
by itself, segments where neighbouring removed ones together have ``MIN_WORDS`` words or more.

Results by case: null and empty texts have no words and nothing to remove; texts and passages under
``MIN_WORDS`` words stay; ties at the threshold are similar; a repeated passage within one text is removed but
for its first place; repeated rows are copies of each other, and those with the same id keep one and the
same verdict; an empty table gives an empty table; other columns, whatever their names, are not read.
Ids are integers; rows without an id are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.clusters import links, packed_sets, tasks
from podium.llm.words import (
    SHINGLE, Words, cut_words, distinct_sets, minhash, mix, pieces, shingles, window_hashes, words_of,
)
from podium.llm.work import ambiguous_ids, components, inner_join, stored

THRESHOLD = 0.8
RECALL = 0.9995
MIN_WORDS = 16
RADIUS = 4


def tune_bands(threshold: float, recall: float, most_chance: float = 0.25, unlike: float = 0.2) -> tuple[int, int]:
    """(bands, rows): the fewest keys with the recall at the threshold.

    Among row counts whose keys bring sets of similarity ``unlike`` together with chance ``most_chance`` at most.
    """
    found = []
    for rows in range(1, 13):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))
        if 1 - (1 - unlike**rows) ** bands <= most_chance:
            found.append((bands, rows))
    return min(found) if found else (bands, rows)


def _lines(words: Words, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of each line that has words; lines end with their text."""
    breaks = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(words.data == 10, out=breaks[1:])
    line = breaks[words.start] + words.text
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(line)))


def _segments(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(first word, words) of the segments of each text."""
    n = len(words.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair = np.append(window_hashes(words.hash, 2), np.uint64(0))
    top = np.iinfo(np.uint64).max
    cut = np.ones(n, bool)
    for k in range(1, RADIUS + 1):
        # Neighbours in other texts count as larger, so that a text's cuts are its own.
        left = np.full(n, top, np.uint64)
        left[k:] = np.where(words.text[k:] == words.text[:-k], pair[:-k], top)
        right = np.full(n, top, np.uint64)
        right[:-k] = np.where(words.text[k:] == words.text[:-k], pair[k:], top)
        cut &= (pair < left) & (pair <= right)
    last = np.append(words.text[1:] != words.text[:-1], True)
    cut &= ~last
    cut[0] = True
    cut[1:] |= words.text[1:] != words.text[:-1]
    first = np.flatnonzero(cut)
    return first, np.diff(np.append(first, n))


def _sequence_digest(hashes: np.ndarray, first: np.ndarray, count: np.ndarray, salt: int) -> np.ndarray:
    """A hash of each run of words, in order."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(first, count).astype(np.uint64)
    weight = mix(place * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt)) | np.uint64(1)
    return mix(np.add.reduceat(hashes * weight, first)) if len(first) else np.zeros(0, np.uint64)


_UNITS = "id long, line boolean, first int, n int, d1 long, d2 int, size long, bands array<long>"


def paragraphs(docs: DataFrame, bands: int, rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines and segments: first word, words, digest; for lines also the size of the set and the band keys."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for row, data, offsets in pieces(batch.column(1)):
                words = words_of(data, offsets)
                first, count = _lines(words, offsets)
                long = count >= MIN_WORDS
                first, count = first[long], count[long]
                item, found = shingles(words.hash, first, count)
                values, bounds = distinct_sets(item, found, len(first))
                sums = np.zeros((2, len(values) + 1), np.uint64)
                for k in (0, 1):
                    np.cumsum(mix(values ^ np.uint64(k + 1)), out=sums[k, 1:], dtype=np.uint64)
                d1, d2 = sums[:, bounds[1:]] - sums[:, bounds[:-1]]
                sketch = minhash(values, bounds, bands * rows).astype(np.uint64).reshape(len(first), bands, rows)
                keys = np.zeros((len(first), bands), np.uint64)
                for k in range(rows):
                    keys = mix(keys ^ sketch[:, :, k])
                keys = mix(keys + np.arange(1, bands + 1, dtype=np.uint64))
                yield made(ids, row, words, True, first, count, d1, d2, np.diff(bounds), keys)
                first, count = _segments(words)
                digests = [_sequence_digest(words.hash, first, count, salt) for salt in (1, 2)]
                yield made(ids, row, words, False, first, count, *digests, None, None)

    def made(ids, row, words, line, first, count, d1, d2, size, keys) -> pa.RecordBatch:
        text = words.text[first] if len(first) else np.zeros(0, np.int64)
        n = len(first)
        lists = pa.nulls(n, pa.list_(pa.int64()))
        if keys is not None:
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.view(np.int64).ravel()))
        columns = [
            pa.array(ids[row + text]), pa.array(np.full(n, line)), pa.array((first - words.first[text]).astype(np.int32)),
            pa.array(count.astype(np.int32)), pa.array(d1.view(np.int64)), pa.array((d2 >> np.uint64(32)).astype(np.uint32).view(np.int32)),
            pa.nulls(n, pa.int64()) if size is None else pa.array(size.astype(np.int64)), lists,
        ]
        return pa.RecordBatch.from_arrays(columns, ["id", "line", "first", "n", "d1", "d2", "size", "bands"])

    kept = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return kept.mapInArrow(over, _UNITS)


def _line_classes(docs: DataFrame, units: DataFrame, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """(d1, root): the class of each set of a line that is similar to another set."""
    sets = units.where("line").groupBy("d1").agg(
        F.min(F.struct("id", "first", "n")).alias("at"), F.first("bands").alias("bands"), F.first("size").alias("size")
    )
    sets = stored(sets, "line-sets")
    keys = sets.select("d1", F.explode("bands").alias("band"))
    groups = keys.groupBy("band").agg(F.min("d1").alias("least"), F.max("d1").alias("most"), F.count(F.lit(1)).alias("m"))
    groups = stored(groups.where("m > 1"), "bands")
    two = groups.where("m = 2").select(F.col("most").alias("a"), F.col("least").alias("b"))
    more = inner_join(keys, groups.where("m > 2").select("band", "least"), ["band"]).select(F.col("d1").alias("a"), F.col("least").alias("b"))
    linked = components(two.union(more))
    members = linked.select(F.col("root").alias("cluster"), F.col("node").alias("id"))
    members = members.union(linked.select("root", "root").distinct())
    members = members.join(sets.select(F.col("d1").alias("id"), F.col("size").alias("n"), "at"), "id")
    dealt = stored(tasks(members.select("cluster", "id", F.lit(1).cast("long").alias("weight"), "n")), "tasks")
    places = members.groupBy(F.col("at.id").alias("doc")).agg(F.collect_list(F.struct("id", "at.first", "at.n")).alias("wanted"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in pieces(batch.column(0)):
                words = words_of(data, offsets)
                wanted = [(w["id"], words.first[i] + w["first"], w["n"]) for i in range(len(offsets) - 1) for w in batch.column(1)[row + i].as_py()]
                first, count = np.array([w[1] for w in wanted], np.int64), np.array([w[2] for w in wanted], np.int64)
                item, found = shingles(words.hash, first, count)
                values, bounds = distinct_sets(item, found, len(wanted))
                ids = pa.array([w[0] for w in wanted], pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(list(packed_sets(values, bounds)), pa.binary())], ["id", "values"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    texts = inner_join(texts, stored(places, "places"), ["doc"]).select("text", "wanted")
    gathered = dealt.join(texts.mapInArrow(over, "id long, values binary"), "id")
    found = links(gathered, threshold)
    return components(stored(found.select("id", "root"), "found"), "id", "root").select(F.col("node").alias("d1"), "root")


def repeated_passages(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_removed, removed_from, removed_to, kept_in), one row per document.

    Word places of the removed runs (the end exclusive), and the ids of the documents in which the passages stay.
    """
    bands, rows = tune_bands(threshold, recall)
    units = stored(paragraphs(docs, bands, rows, id_col, text_col), "paragraphs")
    lines = units.where("line").select("id", "first", "n", "d1")
    classes = _line_classes(docs, units, threshold, id_col, text_col)
    classed = lines.groupBy("d1").agg(F.min(F.struct("id", "first")).alias("own"), F.count(F.lit(1)).alias("m"))
    classed = classed.join(classes, "d1", "left").withColumn("root", F.coalesce("root", "d1"))
    classed = stored(classed, "classed")
    keepers = classed.groupBy("root").agg(F.min("own").alias("keep"), F.sum("m").alias("m")).where("m > 1")
    known = classed.join(keepers.select("root", "keep"), "root").select("d1", "keep")
    moved = (F.col("id") != F.col("keep.id")) | (F.col("first") != F.col("keep.first"))
    gone = lines.join(known, "d1").where(moved).select("id", "first", "n", F.col("keep.id").alias("kept_in"), F.lit(True).alias("line"))
    segments = units.where("not line").select("id", "first", "n", "d1", "d2")
    repeats = segments.groupBy("d1", "d2", "n").agg(F.min(F.struct("id", "first")).alias("keep"), F.count(F.lit(1)).alias("m"))
    repeats = repeats.where("m > 1").drop("m")
    cut = segments.join(repeats, ["d1", "d2", "n"]).where(moved).select("id", "first", "n", F.col("keep.id").alias("kept_in"), F.lit(False).alias("line"))
    marks = gone.union(cut).groupBy("id").agg(F.collect_list(F.struct("first", "n", "kept_in", "line")).alias("marks"))
    every = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    spans = every.join(marks.mapInArrow(_merged, _SPANS), "id", "left")
    nothing = F.array().cast("array<int>")
    return spans.select(
        F.col("id").alias(id_col),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed_from", nothing).alias("removed_from"),
        F.coalesce("removed_to", nothing).alias("removed_to"),
        F.coalesce("kept_in", F.array().cast("array<long>")).alias("kept_in"),
    )


_SPANS = "id long, n_removed long, removed_from array<int>, removed_to array<int>, kept_in array<long>"


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The removed runs of words of each document from its marked lines and segments."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for marks in batch.column(1).to_pylist():
            segments = sorted((m["first"], m["first"] + m["n"], m["kept_in"]) for m in marks if not m["line"])
            runs: list[tuple[int, int, set[int]]] = []
            for first, end, kept_in in dict.fromkeys(segments):
                if runs and runs[-1][1] == first:
                    runs[-1] = (runs[-1][0], end, runs[-1][2] | {kept_in})
                else:
                    runs.append((first, end, {kept_in}))
            runs = [run for run in runs if run[1] - run[0] >= MIN_WORDS]
            runs += [(m["first"], m["first"] + m["n"], {m["kept_in"]}) for m in marks if m["line"]]
            merged: list[tuple[int, int]] = []
            for first, end, _ in sorted(runs, key=lambda run: run[:2]):
                if merged and first <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(merged[-1][1], end))
                else:
                    merged.append((first, end))
            out[0].append(sum(end - first for first, end in merged))
            out[1].append([first for first, _ in merged])
            out[2].append([end for _, end in merged])
            out[3].append(sorted(set().union(*(run[2] for run in runs))))
        types = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))
        columns = [batch.column(0), *(pa.array(values, kind) for values, kind in zip(out, types, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n_removed", "removed_from", "removed_to", "kept_in"])


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with each removed run of words replaced by one space, with all their columns.

    Texts that share an id stay as they are: the runs of one say nothing of another.
    """
    spans = repeated_passages(docs, id_col=id_col, text_col=text_col, **settings).where("n_removed > 0")
    spans = spans.select(F.col(id_col).alias("__id"), "removed_from", "removed_to").dropDuplicates(["__id"])
    spans = spans.join(ambiguous_ids(docs, id_col, text_col), F.col("__id") == F.col("__many"), "left_anti")
    joined = docs.join(spans, docs[id_col] == spans["__id"], "left")
    text = F.arrow_udf(cut_words, "string")(docs[text_col], spans["removed_from"], spans["removed_to"])
    return joined.select(*(text.alias(c) if c == text_col else docs[c] for c in docs.columns))
