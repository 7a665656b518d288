"""Exact duplicates by progressive refinement, in DataFrame functions only.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became one space. One pass
over the texts leaves a row of digests per document: length, a hash of the first characters, and the full
hash. Documents are grouped by length; the groups of more than one are split by the prefix hash; only
rows of groups still shared are grouped by the full SHA-256. Each step is a count with partial sums and a
semi-join on digests, so a group with a third of all rows costs one partial row per task, and the texts
themselves are never shuffled. The row with the smallest id of a group stays.

Results by case: null counts as an empty text, and empty texts equal each other; ties and repeated rows
(also rows with the same id) count each in ``group_size``; rows with equal ids and texts are all kept or
all dropped; an empty table gives an empty table; other columns of the input, whatever their names, are
not read. Null ids never stay while their text has a row with an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.work import stored

PREFIX_CHARS = 64


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS) -> DataFrame:
    """(id, n, p, h): length, prefix hash and SHA-256 of each normalised text."""
    whole = docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("t"))
    return whole.select(
        "id",
        F.octet_length("t").alias("n"),
        F.xxhash64(F.substring("t", 1, prefix)).alias("p"),
        F.sha2("t", 256).alias("h"),
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX_CHARS) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per document."""
    rows = stored(digests(docs, id_col, text_col, prefix), "digests")
    shared = rows.groupBy("n").count().where("count > 1").select("n")
    rest = rows.join(shared, ["n"], "left_semi")
    shared = rest.groupBy("n", "p").count().where("count > 1").select("n", "p")
    rest = rest.join(shared, ["n", "p"], "left_semi")
    groups = (
        rest.groupBy("n", "p", "h").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("size")).where("size > 1")
    )
    return rows.join(groups.select("h", "keep", "size"), "h", "left").select(
        F.col("id").alias(id_col),
        F.coalesce("keep", "id").alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.coalesce("keep", "id")).alias("kept"),
        F.col("h").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; a row is judged by its id and text."""
    dropped = exact_groups(docs, id_col, text_col).where("not kept")
    dropped = dropped.select(F.col(id_col).alias("__dropped"), F.col("text_sha256").alias("__text")).distinct()
    same = docs[id_col].eqNullSafe(dropped["__dropped"]) & (F.sha2(normalised(text_col), 256) == dropped["__text"])
    return docs.join(dropped, same, "left_anti")
