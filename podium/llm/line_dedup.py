"""Line dedup by a deletion-neighbourhood join: lines within one edit of an earlier line are dropped.

Lines end at ``\\n``; runs of ``[\\x20\\x09-\\x0D]`` become one space and the ends are trimmed before lines
are compared. Equal lines are one distinct line with its earliest place. Distinct lines of ``MIN_CHARS``
characters or more also match at edit distance 1 (a character put in, left out or replaced).

Every deletion variant of a line is a key: the hash of the line without its character at a place, made for
all places at once from prefix sums. Two lines that differ by a replaced character share the variant and
the place; a line that lacks a character is itself a variant of the other. Keys are grouped, never
collected: all lines of a variant and place are one replaced character apart, so pointing each to the
least of them loses nothing. Each link is then verified by its edit distance, and components of the links are
the classes. Only lines that can have a partner emit variants: one edit leaves the first or the second half
of a line as it is, so lines which share neither half with another line are left out beforehand,
exactly.

In each class the earliest line, by document id and then by line number, stays.

Results by case: null and empty texts have one blank line; blank lines match nothing and stay; ties cannot
occur, as places differ; repeated rows are copies of each other, and those with the same id keep the same
verdict for each line; an empty table gives an empty table; other columns, whatever their names, are not
read. Ids are integers; rows without an id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.words import mix
from podium.llm.work import ambiguous_ids, components, inner_join, semi_join, stored

MIN_CHARS = 12
_BASE = 0x9E3779B97F4A7C15


def _normalised(line: str) -> Column:
    return F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))


def _half_keys(line: str) -> Column:
    """Hashes of both halves, once as the shorter (or equal) and once as the longer of two lines."""
    n = F.char_length(line)
    keys = []
    for own in (n, n - 1):
        half = F.floor(own / 2).cast("int")
        keys.append(F.xxhash64(F.substring(line, F.lit(1), half), own, F.lit("first")))
        keys.append(F.xxhash64(F.substring(line, n - own + half + 1, own - half), own, F.lit("second")))
    return F.when(n >= MIN_CHARS, F.array(*keys))


def lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, h1, h2, halves) of the lines that are not blank."""
    kept = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line", "raw")
    )
    kept = kept.select("id", "line", _normalised("raw").alias("key")).where("key != ''")
    return kept.select(
        "id", "line", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), _half_keys("key").alias("halves")
    )


def deletions(codes: np.ndarray) -> np.ndarray:
    """Hashes of a line (its code points) without the character at each place; the last is the whole line's."""
    n = len(codes)
    powers = np.full(n, _BASE, np.uint64)
    powers[0] = 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(codes.astype(np.uint64) * np.cumprod(powers), out=total[1:])
    back = np.uint64(pow(_BASE, -1, 1 << 64))
    out = np.empty(n + 1, np.uint64)
    out[:n] = total[:n] + (total[n] - total[1:]) * back
    out[n] = total[n]
    out[:n] += np.uint64(n - 1) << np.uint64(40)
    out[n] += np.uint64(n) << np.uint64(40)
    return mix(out)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["variant", "place", "h1"]
    for batch in batches:
        held: list[tuple[np.ndarray, int]] = []
        size = 0
        for h1, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.append((deletions(np.frombuffer(key.encode("utf-32-le"), "<u4")), h1))
            size += len(key) + 1
            if size > 1 << 20:
                yield _variant_rows(held, names)
                held, size = [], 0
        if held:
            yield _variant_rows(held, names)


def _variant_rows(held: list[tuple[np.ndarray, int]], names: list[str]) -> pa.RecordBatch:
    """Rows of deletion variants; the whole line's has the place -1."""
    sizes = [len(v) for v, _ in held]
    place = np.concatenate([np.append(np.arange(n - 1), -1) for n in sizes]).astype(np.int32)
    columns = [np.concatenate([v for v, _ in held]).view(np.int64), place, np.repeat([h for _, h in held], sizes)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _edges(keys: DataFrame, on: list[str]) -> DataFrame:
    """(a, b): each line of a key pointed to the least of its lines."""
    groups = keys.groupBy(*on).agg(F.min("h1").alias("least"), F.max("h1").alias("most"), F.count(F.lit(1)).alias("m"))
    groups = stored(groups.where("least != most"), "groups")
    two = groups.where("m = 2").select(F.col("most").alias("a"), F.col("least").alias("b"))
    more = inner_join(keys, groups.where("m > 2").select(*on, "least"), on)
    return two.union(more.where("h1 != least").select(F.col("h1").alias("a"), F.col("least").alias("b")))


def near_lines(docs: DataFrame, distinct: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(a, b): links between distinct lines (h1, at, halves) at edit distance 1, enough of them to connect their classes."""
    halves = distinct.select("h1", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.min("h1").alias("x"), F.max("h1").alias("y")).where("x != y").select("half")
    able = stored(semi_join(halves, stored(shared, "halves"), ["half"]).select("h1").distinct(), "able")
    places = semi_join(distinct.select("h1", "at"), able, ["h1"])
    places = places.groupBy(F.col("at.id").alias("id")).agg(F.collect_list(F.struct("h1", "at.line")).alias("wanted"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.split(F.col(text_col).cast("string"), "\n").alias("rows"))
    texts = inner_join(texts, stored(places, "places"), ["id"]).select("rows", F.explode("wanted").alias("w"))
    keyed = texts.select(F.col("w.h1").alias("h1"), F.element_at("rows", F.col("w.line") + 1).alias("raw"))
    keyed = stored(keyed.select("h1", _normalised("raw").alias("key")).where(F.xxhash64("key") == F.col("h1")).dropDuplicates(["h1"]), "lines")
    variants = stored(keyed.mapInArrow(_variants, "variant long, place int, h1 long"), "variants")
    replaced = _edges(variants.where("place >= 0"), ["variant", "place"])
    whole = variants.where("place < 0").select("variant", F.col("h1").alias("b"))
    left_out = inner_join(variants.where("place >= 0").select("variant", F.col("h1").alias("a")), whole, ["variant"])
    found = replaced.union(left_out.select("a", "b")).where("a != b").distinct()
    found = found.join(keyed.select(F.col("h1").alias("a"), F.col("key").alias("x")), "a")
    found = found.join(keyed.select(F.col("h1").alias("b"), F.col("key").alias("y")), "b")
    return found.where(F.levenshtein("x", "y", 1) == 1).select("a", "b")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, line, keep): each line that is not blank with the place (id, line) of the line that stays for it."""
    rows = stored(lines(docs, id_col, text_col), "lines")
    distinct = rows.groupBy("h1", "h2").agg(F.min(F.struct("id", "line")).alias("at"), F.first("halves").alias("halves"))
    distinct = stored(distinct, "distinct")
    classes = components(near_lines(docs, distinct.where("halves is not null"), id_col, text_col))
    classed = distinct.select("h1", "h2", "at").join(classes.withColumnRenamed("node", "h1"), "h1", "left")
    classed = stored(classed.withColumn("root", F.coalesce("root", "h1")), "classed")
    keepers = classed.groupBy("root").agg(F.min("at").alias("keep"))
    known = classed.join(keepers, "root").select("h1", "h2", "keep")
    return rows.select("id", "line", "h1", "h2").join(known, ["h1", "h2"]).select("id", "line", "keep")


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_dropped, dropped, kept_in), one row per document: numbers of the dropped lines, documents that keep them."""
    moved = (F.col("id") != F.col("keep.id")) | (F.col("line") != F.col("keep.line"))
    dropped = line_classes(docs, id_col, text_col).where(moved)
    dropped = dropped.groupBy("id").agg(
        F.array_sort(F.collect_set("line")).alias("dropped"), F.array_sort(F.collect_set("keep.id")).alias("kept_in")
    )
    every = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"))
    found = every.join(dropped, "id", "left")
    return found.select(
        F.col("id").alias(id_col),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
        F.coalesce("kept_in", F.array().cast("array<long>")).alias("kept_in"),
    )


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without their dropped lines, with all their columns; a text may become empty.

    Texts that share an id stay as they are: the lines of one say nothing of another.
    """
    gone = repeated_lines(docs, id_col, text_col).where("n_dropped > 0")
    gone = gone.select(F.col(id_col).alias("__id"), F.col("dropped").alias("__dropped")).dropDuplicates(["__id"])
    gone = gone.join(ambiguous_ids(docs, id_col, text_col), F.col("__id") == F.col("__many"), "left_anti")
    joined = docs.join(gone, docs[id_col] == gone["__id"], "left")
    kept = F.filter(F.split(docs[text_col].cast("string"), "\n"), lambda x, i: ~F.array_contains(gone["__dropped"], i))
    text = F.when(gone["__dropped"].isNull(), docs[text_col].cast("string")).otherwise(F.array_join(kept, "\n"))
    return joined.select(*(text.alias(c) if c == text_col else docs[c] for c in docs.columns))
