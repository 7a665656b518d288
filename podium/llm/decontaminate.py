"""Benchmark decontamination: a hash set of the benchmark's word windows, scanned over every document.

Texts are words (see ``words``): A-Z lower-cased, runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Each
benchmark item contributes the hashes of its windows of ``window`` consecutive words; an item of fewer
words, but not none, is one window. Tasks hash every window of a document at once, look the hashes up in
the benchmark's, and compare the words of each hit, so that a chance collision marks nothing. Documents are
read once and not shuffled.

The windows are broadcast after their number was counted, once for each item that has them. A benchmark beyond
``max_windows`` takes another way to the same rows: windows that occur in no document by hash are dropped in a
shuffled join, and if the others are too many as well, a numbered copy of the documents is scanned block by block.

Results by case: null and empty documents have no words and no hits; null and empty items have no windows,
and null item ids are ignored; repeated items and items with equal texts count by their distinct ids;
overlapping windows mark a word once; repeated documents are judged each; empty tables give no hits; other
columns of either input, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from podium.llm.words import Words, cut_words, pieces, window_hashes, words_of
from podium.llm.work import row_key, stored

WINDOW = 10
MAX_WINDOWS = 2_000_000

_Windows = dict[int, dict[int, list[tuple[tuple[bytes, ...], list[str]]]]]


def _item_windows(words: Words, i: int, window: int) -> tuple[int, np.ndarray]:
    """(size, places of their first words) of an item's windows."""
    first, count = int(words.first[i]), int(words.count[i])
    size = min(window, count)
    return size, np.arange(first, first + count - size + 1) if size else np.zeros(0, np.int64)


def benchmark_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(size, hash, words, item): every window of every item, once per item."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for row, data, offsets in pieces(batch.column(1)):
                words = words_of(data, offsets)
                for i in range(len(words.count)):
                    size, places = _item_windows(words, i, window)
                    hashes = window_hashes(words.hash, size) if size else ()
                    for place in places.tolist():
                        rows[0].append(size)
                        rows[1].append(int(hashes[place].view(np.int64)))
                        rows[2].append(b" ".join(words.word(k) for k in range(place, place + size)))
                        rows[3].append(batch.column(0)[row + i].as_py())
            types = (pa.int32(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names)

    names = ["size", "hash", "words", "item"]
    kept = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    return kept.mapInArrow(over, "size int, hash long, words binary, item string").distinct()


def _lookup(rows: list) -> _Windows:
    """size -> hash -> windows with that hash and the items that have them."""
    found: _Windows = defaultdict(lambda: defaultdict(list))
    for size, value, words, items in rows:
        found[size][value & (1 << 64) - 1].append((words, items))
    return {size: dict(windows) for size, windows in found.items()}


class _Scanner:
    """Marks the words of documents that lie in a window of the lookup."""

    def __init__(self, lookup: _Windows) -> None:
        self.lookup = lookup
        self.hashes = {size: np.sort(np.array(list(windows), np.uint64)) for size, windows in lookup.items()}
        self.filters = {}
        for size, hashes in self.hashes.items():
            bits = max(16, int(len(hashes)).bit_length() + 6)
            marked = np.zeros(1 << bits, bool)
            marked[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.filters[size] = (np.uint64(64 - bits), marked)

    def hits(self, words: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(place of the first word, size, items) of each window that occurs within one text."""
        for size, hashes in self.hashes.items():
            found = window_hashes(words.hash, size)
            shift, marked = self.filters[size]
            places = np.flatnonzero(marked[(found >> shift).astype(np.int64)])
            places = places[words.text[places] == words.text[places + size - 1]]
            if len(places):
                at = np.minimum(np.searchsorted(hashes, found[places]), len(hashes) - 1)
                places = places[hashes[at] == found[places]]
            for place in places.tolist():
                own = b" ".join(words.word(k) for k in range(place, place + size))
                for known, items in self.lookup[size][int(found[place])]:
                    if known == own:
                        yield place, size, items


def _report(words: Words, hits: Iterator[tuple[int, int, list[str]]]) -> Iterator[tuple[list, list, list]]:
    """Per text: items, and the hit runs as [first word, end) pairs."""
    items: dict[int, set[str]] = defaultdict(set)
    hit = np.zeros(len(words.start), bool)
    for place, size, names in hits:
        items[int(words.text[place])].update(names)
        hit[place : place + size] = True
    for i in range(len(words.count)):
        if i not in items:
            yield [], [], []
            continue
        own = np.zeros(words.count[i] + 2, bool)
        own[1:-1] = hit[words.first[i] : words.first[i] + words.count[i]]
        turns = np.flatnonzero(own[1:] != own[:-1])
        yield sorted(items[i]), turns[::2].tolist(), turns[1::2].tolist()


_SCHEMA = "n_words long, items array<string>, hit_from array<int>, hit_to array<int>"


def _scan(docs: DataFrame, scanner: Callable[[], _Scanner], id_col: str, text_col: str) -> DataFrame:
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = scanner()
        for batch in batches:
            counts, rows = [], []
            for _, data, offsets in pieces(batch.column(1)):
                words = words_of(data, offsets)
                counts.append(words.count)
                rows += _report(words, scan.hits(words))
            columns = [
                batch.column(0),
                pa.array(np.concatenate(counts) if counts else [], pa.int64()),
                pa.array([r[0] for r in rows], pa.list_(pa.string())),
                pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                pa.array([r[2] for r in rows], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = [id_col, "n_words", "items", "hit_from", "hit_to"]
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).mapInArrow(over, f"`{id_col}` {kind}, {_SCHEMA}")


def _matching(docs: DataFrame, windows: DataFrame, text_col: str) -> DataFrame:
    """The windows that occur in documents by hash: the benchmark's windows, cut to those a scan can meet."""
    sizes = [row["size"] for row in windows.select("size").distinct().collect()]  # at most as many as words in a window

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in pieces(batch.column(0)):
                words = words_of(data, offsets)
                for size in sizes:
                    found = window_hashes(words.hash, size)
                    inside = words.text[: len(found)] == words.text[size - 1 : size - 1 + len(found)]
                    found = np.unique(found[inside]).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), size, np.int32)), pa.array(found)], ["size", "hash"])

    met = docs.select(F.col(text_col).cast("string")).mapInArrow(over, "size int, hash long").distinct()
    return windows.join(met.hint("merge"), ["size", "hash"], "left_semi")


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, n_words, items, hit_from, hit_to), one row per document: sorted item ids, and runs of hit words.

    ``max_windows`` bounds what is broadcast at once, in pairs of a window and an item, about. Of a larger
    benchmark only the windows whose hash occurs in the documents are kept (a shuffled join); if these are too
    many as well, the documents are scanned once for each block of pairs and the marks of each row are united.
    """
    spark = docs.sparkSession
    windows = benchmark_windows(items, window, item_col, item_text_col)
    n = windows.limit(max_windows + 1).count()
    if n > max_windows:
        windows = stored(_matching(docs, windows, text_col), "windows")
        n = windows.count()
    blocks = max(1, -(-n // max_windows))
    if blocks == 1:
        return _scan(docs, _scanner(spark, windows), id_col, text_col)
    # Rows with one id, or none, stay apart by their number; the copy keeps it the same in all scans.
    numbered = docs.select(
        F.struct(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id")).alias("key"), F.col(text_col).cast("string").alias("text")
    )
    numbered = stored(numbered, "numbered")
    found = None
    for block in range(blocks):
        own = windows.where(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == block)
        rows = _scan(numbered, _scanner(spark, own), "key", "text")
        found = rows if found is None else found.union(rows)
    return _united(found, id_col)


def _scanner(spark: SparkSession, windows: DataFrame) -> Callable[[], _Scanner]:
    """A scanner over broadcast windows."""
    grouped = windows.groupBy("size", "hash", "words").agg(F.sort_array(F.collect_list("item")).alias("items"))
    sent = spark.sparkContext.broadcast([tuple(row) for row in grouped.collect()])
    return lambda: _Scanner(_lookup(sent.value))


def _united(rows: DataFrame, id_col: str) -> DataFrame:
    """The marks of several scans of the same rows (key: row and id) as one row each."""
    places = F.flatten(F.transform(F.arrays_zip("hit_from", "hit_to"), lambda r: F.sequence(r["hit_from"], r["hit_to"] - 1)))
    marked = rows.groupBy("key", "n_words").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list(places)))).alias("w"),
    )
    begins = F.filter("w", lambda x: ~F.array_contains("w", x - 1))
    ends = F.transform(F.filter("w", lambda x: ~F.array_contains("w", x + 1)), lambda x: x + 1)
    return marked.select(F.col("key.id").alias(id_col), "n_words", "items", begins.alias("hit_from"), ends.alias("hit_to"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **settings) -> DataFrame:
    """The documents without any occurrence, with all their columns; a row is judged by its id and text."""
    keyed = docs.withColumn("__row", row_key(id_col, settings.get("text_col", "text")))
    hit = contamination(keyed, items, id_col="__row", **settings).where(F.size("items") > 0).select("__row").distinct()
    return keyed.join(hit, "__row", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def remove_spans(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """The documents with each run of hit words replaced by one space, with all their columns."""
    keyed = docs.withColumn("__row", row_key(id_col, text_col))
    hits = contamination(keyed, items, id_col="__row", text_col=text_col, **settings).where(F.size("items") > 0)
    hits = hits.select("__row", "hit_from", "hit_to").dropDuplicates(["__row"])
    joined = keyed.join(hits, "__row", "left")
    text = F.arrow_udf(cut_words, "string")(keyed[text_col], hits["hit_from"], hits["hit_to"])
    return joined.select(*(text.alias(c) if c == text_col else keyed[c] for c in docs.columns))
