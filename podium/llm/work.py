"""Helpers that the operators share: shared folders, streaming over groups, components, proven broadcasts."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import podium
from podium.session import work_folder

#: Rows of (id, id) that may be broadcast: about 32 MB.
BROADCAST_ROWS = 1_000_000

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to the Python workers, once per application."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        root = Path(podium.__file__).resolve().parent
        if root.is_dir():
            target = Path(tempfile.mkdtemp(prefix="podium-code-")) / "podium_code.zip"
            with zipfile.ZipFile(target, "w") as archive:
                for path in sorted(root.rglob("*.py")):
                    archive.write(path, path.relative_to(root.parent))
            spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(application)
    return spark


def stored(rows: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows, written once to the shared work folder and read from there; cuts the lineage."""
    folder = work_folder(rows.sparkSession, label)
    rows.write.parquet(folder, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def semi_join(rows: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose key is among distinct ``keys``; the keys are broadcast only when counted below ``limit``."""
    few = keys.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(keys) if few else keys.hint("merge"), on, "left_semi")


def inner_join(rows: DataFrame, keys: DataFrame, on: list[str], limit: int = BROADCAST_ROWS) -> DataFrame:
    """Like ``semi_join``, with the other columns of ``keys``."""
    few = keys.limit(limit + 1).count() <= limit
    return rows.join(F.broadcast(keys) if few else keys.hint("merge"), on)


def row_key(id_col: str, text_col: str) -> Column:
    """Tells rows apart by their id and text, null ids included: rows alike in both share every verdict."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("text"))


def ambiguous_ids(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Ids that stand for different texts, as column ``__many``."""
    text = F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    many = docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__many"))
    return many.agg(F.min(text).alias("low"), F.max(text).alias("high")).where("low != high").select("__many")


def map_groups(
    rows: DataFrame, key: str, function: Callable[[pa.Table], pa.Table | None], schema: str
) -> DataFrame:
    """Apply a function to the rows of each key, one bounded group in memory at a time.

    Rows are dealt by key and sorted; a group is handed on as an Arrow table once the next key begins.
    Groups must be bounded by the caller.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(key).to_numpy(zero_copy_only=False)
            cuts = [*((keys[1:] != keys[:-1]).nonzero()[0] + 1).tolist(), batch.num_rows]
            if held and held[-1].column(key)[0].as_py() != keys[0].item():
                cuts.insert(0, 0)
            begin = 0
            out = []
            for cut in cuts[:-1]:
                held.append(batch.slice(begin, cut - begin))
                out.append(function(pa.Table.from_batches([b for b in held if b.num_rows])))
                held, begin = [], cut
            held.append(batch.slice(begin))
            if out := [t for t in out if t is not None and t.num_rows]:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
        if held and (last := function(pa.Table.from_batches(held))) is not None:
            yield from last.combine_chunks().to_batches()

    dealt = rows.repartition(key).sortWithinPartitions(key)
    return dealt.mapInArrow(over, schema)


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """(node, root): the least node that each node of the edges is connected with.

    Alternating stars: each node points its larger neighbours, then its smaller ones, to the least of
    them, until every node points to a node that points nowhere. Groups are only ever reduced to their
    minimum, so a hub with any number of links is never collected.
    """
    a, b = F.col(first).cast("long"), F.col(second).cast("long")
    pairs = stored(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while not _all_stars(pairs):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        pairs = (
            small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        pairs = stored(pairs, "edges")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _all_stars(pairs: DataFrame) -> bool:
    """Whether no node points to two nodes, and none that is pointed to points on."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.union(pairs.select("v", F.lit(0), F.lit(1)))
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return counts.where("out > 1 or (out = 1 and into = 1)").isEmpty()
