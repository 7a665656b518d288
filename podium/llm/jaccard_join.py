"""Similarity join of word 5-gram sets by chosen paths.

**Sets.** A document is the set of hashes of its word shingles (64 bits, taken as exact). Documents with the
same set are one representative with a weight, so copies are never compared with each other.

**Candidates.** Each representative has a MinHash sketch. The join walks ``runs`` independent trees: in a node,
``BRANCH`` positions of the sketch are sampled by a hash of the path, and the members that share the token there
go on together to a child. A pair of similarity s shares at least one child of a node with chance 1-(1-s)²,
and the chance that it is never separated has, at any depth, the fixed point of q = 1-(1-sq)²; that is 0.94 for
s = 0.8, so ``runs`` trees miss a pair with chance (1-q)^runs, chosen below ``1 - recall``. Nodes of at
most ``bucket`` members are compared by brute force on their sketches, in blocks of bounded size; larger ones
are split again. A
crowd of near copies would never split: in a large node the members that the sketch puts within 0.1 of its
first member are linked to that one member and leave (whatever is 0.8 similar to them is still close enough to
be linked with it too), and the rest go on. What is large at the last level is compared in blocks.

**Result.** Links of sketches that could be similar (a cutoff several deviations below the threshold) connect
representatives to candidate clusters. Each cluster's sets are computed once more from the texts and all
pairs of a cluster are compared exactly (``clusters``): this gives the links and the classes.

Results by case: null texts and texts without words have no set, link with nothing and are a class each;
texts of fewer than 5 words are one shingle of all of them; ties at the threshold are links; repeated rows
link as copies; an empty table gives an empty table; other columns, whatever their names, are not read. Ids
are integers that identify documents: of rows with the same id one stands for all. Rows without an id are left
out of the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.clusters import links, packed_sets, roots, tasks
from podium.llm.words import SHINGLE, distinct_sets, minhash, mix, pieces, shingles, words_of
from podium.llm.work import ambiguous_ids, components, inner_join, map_groups, semi_join, stored

THRESHOLD = 0.8
RECALL = 0.9999
SKETCH = 128
BRANCH = 2
BUCKET = 4096
BLOCK = 1024
DEPTH = 6
#: First members of large nodes whose sketches may be broadcast: about 10 MB.
MAX_LEADS = 10_000


def runs_for(recall: float, threshold: float) -> int:
    """Trees needed so that a pair at the threshold is missed with chance ``1 - recall`` at most."""
    q = 1.0
    for _ in range(200):
        q = 1 - (1 - threshold * q) ** BRANCH
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - q)))


def cutoff(threshold: float, recall: float) -> int:
    """Equal sketch values below which a pair is dropped; a pair at the threshold falls below with a chance far under ``1 - recall``.

    Buckets compare one byte of each value, so that unlike values agree now and then: that only adds candidates.
    """
    chance, k = 0.0, 0
    while True:
        chance += math.comb(SKETCH, k) * threshold**k * (1 - threshold) ** (SKETCH - k)
        if chance > (1 - recall) / 10:
            return k
        k += 1


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, values, offsets) of the shingle sets of the texts of a column."""
    for row, data, offsets in pieces(column):
        words = words_of(data, offsets)
        item, found = shingles(words.hash, words.first, words.count, size)
        yield row, *distinct_sets(item, found, len(words.count))


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(id, n, d1, d2, sketch, brief): size, a 128-bit digest, the MinHash sketch and its low bytes, of each document's set."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values, offsets in _sets(batch.column(1), size):
                n = np.diff(offsets)
                digests = []
                for salt in (1, 2):
                    total = np.zeros(len(values) + 1, np.uint64)
                    np.cumsum(mix(values ^ np.uint64(salt)), out=total[1:], dtype=np.uint64)
                    digests.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
                tokens = minhash(values, offsets, SKETCH).view(np.int32)
                brief = pa.array([row.tobytes() for row in (tokens & 255).astype(np.uint8)], pa.binary())
                sketch = pa.ListArray.from_arrays(np.arange(0, tokens.size + 1, SKETCH, dtype=np.int32), tokens.ravel())
                own = batch.column(0).slice(row, len(n))
                yield pa.RecordBatch.from_arrays([own, pa.array(n), pa.array(digests[0]), pa.array(digests[1]), sketch, brief], names)

    names = ["id", "n", "d1", "d2", "sketch", "brief"]
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(over, "id long, n long, d1 long, d2 long, sketch array<int>, brief binary")


def _children(path: str) -> Column:
    """The paths of a member's children: two different positions, sampled by a hash of the node's path."""
    first = F.pmod(F.xxhash64(path, F.lit("position")), F.lit(SKETCH)).cast("int")
    step = F.pmod(F.xxhash64(path, F.lit("step")), F.lit(SKETCH - 1)).cast("int") + 1
    second = F.pmod(first + step, F.lit(SKETCH))
    return F.array(*(F.xxhash64(F.col(path), p, F.element_at("sketch", p + 1)) for p in (first, second)))


def _matches(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)


def _bucket_edges(rows: DataFrame, least: int) -> DataFrame:
    """Trees (a, b) over the pairs of each bucket (path, id, brief) with ``least`` equal bytes or more."""

    def over(table: pa.Table) -> pa.Table | None:
        table = table.combine_chunks().sort_by("id")
        ids = table["id"].to_numpy()
        tokens = np.frombuffer(b"".join(table["brief"].to_pylist()), np.uint8).reshape(len(ids), SKETCH).T.copy()
        equal = np.zeros((len(ids), len(ids)), np.int16)
        for k in range(SKETCH):
            equal += tokens[k, :, None] == tokens[k, None, :]
        root = roots(equal >= least)
        own = root != np.arange(len(ids))
        return pa.table({"a": ids[own], "b": ids[root[own]]}) if own.any() else None

    return map_groups(rows, "path", over, "a long, b long")


def candidates(
    reps: DataFrame, threshold: float, recall: float, bucket: int = BUCKET, depth: int = DEPTH, block: int = BLOCK
) -> DataFrame:
    """(a, b): links of representatives (id, sketch, brief) that connect all pairs which could be similar."""
    least = cutoff(threshold, recall)
    close = math.ceil(SKETCH * (1 - (1 - threshold) / 2))
    runs = runs_for(recall, threshold)
    trees = reps.select("id", "sketch", F.explode(F.array(*(F.xxhash64(F.lit("tree"), F.lit(r)) for r in range(runs)))).alias("path"))
    nodes = stored(trees.select("id", F.explode(_children("path")).alias("path")), "nodes")
    small, edges = [], []
    for level in range(1, depth + 1):
        sizes = stored(nodes.groupBy("path").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "sizes")
        met = stored(inner_join(nodes, sizes, ["path"]), "met")
        small.append(met if level == depth else met.where(F.col("m") <= bucket))
        large = met.where(F.col("m") > bucket)
        if level == depth or large.isEmpty():
            break
        firsts = stored(large.groupBy("path").agg(F.min("id").alias("first")), "firsts")
        leads = inner_join(reps.select(F.col("id").alias("first"), F.col("sketch").alias("lead")), firsts, ["first"])
        # Only the sketches of members of large nodes move, and the leads meet them where they are.
        own = stored(semi_join(reps.select("id", "sketch"), stored(large.select("id").distinct(), "members"), ["id"]), "own")
        members = inner_join(large.select("path", "id").join(own, "id"), stored(leads, "leads"), ["path"], MAX_LEADS)
        judged = stored(members.select("path", "id", "first", "sketch", _matches("sketch", "lead").alias("equal")), "judged")
        linked = judged.where((F.col("equal") >= least) & (F.col("id") != F.col("first")))
        edges.append(linked.select(F.col("id").alias("a"), F.col("first").alias("b")))
        nodes = stored(judged.where(F.col("equal") < close).select("id", F.explode(_children("path")).alias("path")), "nodes")
    pooled = reduce(DataFrame.union, small)
    # Trees often keep the same members together: one bucket of each kind is enough.
    kinds = pooled.groupBy("path", "m").agg(F.min("id").alias("first"), F.bit_xor(F.xxhash64("id")).alias("who"))
    kinds = stored(kinds.groupBy("m", "first", "who").agg(F.min("path").alias("path")).select("path"), "kinds")
    pooled = semi_join(pooled, kinds, ["path"])
    # A bucket beyond the size of a block is compared in pairs of its blocks.
    blocks = F.ceil(F.col("m") / block).cast("int")
    pooled = pooled.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), blocks).cast("int"))
    pooled = pooled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pooled = stored(pooled.select(F.xxhash64("path", F.least("own", "other"), F.greatest("own", "other")).alias("path"), "id"), "pooled")
    found = _bucket_edges(inner_join(reps.select("id", "brief"), pooled, ["id"]).select("path", "id", "brief"), least)
    return stored(reduce(DataFrame.union, edges, found).distinct(), "links")


def similarity_classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket: int = BUCKET,
    depth: int = DEPTH,
    size: int = SHINGLE,
) -> DataFrame:
    """(id, class_id, n_links, n_copies, n_set_links), one row per document.

    ``class_id`` is the least id connected by links, ``n_links`` the number of other documents of similarity
    ``threshold`` or more (copies count each), ``n_copies`` the documents with the same set, this one
    included, and ``n_set_links`` the different sets linked.
    """
    made = stored(sketches(docs, id_col, text_col, size), "sketches")
    sets = made.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    sets = stored(sets, "sets")
    reps = semi_join(made.select("id", "sketch", "brief"), sets.select(F.col("rep").alias("id")), ["id"])
    if not reps.groupBy("id").count().where("count > 1").isEmpty():
        reps = reps.dropDuplicates(["id"])
    reps = stored(reps, "representatives")
    edges = candidates(reps, threshold, recall, bucket, depth)
    grouped = components(edges)
    clustered = grouped.select(F.col("root").alias("cluster"), F.col("node").alias("id"))
    clustered = clustered.union(grouped.select("root", "root").distinct())
    weights = sets.select(F.col("rep").alias("id"), F.col("copies").alias("weight"), "n")
    dealt = stored(tasks(clustered.join(weights, "id")), "tasks")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, values, offsets in _sets(batch.column(1), size):
                packed = pa.array(list(packed_sets(values, offsets)), pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, len(packed)), packed], ["id", "values"])

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    texts = semi_join(texts, dealt.select("id").distinct(), ["id"])
    gathered = inner_join(texts.mapInArrow(over, "id long, values binary"), dealt, ["id"])
    found = stored(links(gathered, threshold), "found")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"), F.sum("set_links").alias("set_links"))
    classes = components(found, "id", "root")
    answers = counted.join(classes.select(F.col("node").alias("id"), "root"), "id", "left").withColumnRenamed("id", "rep")
    answered = sets.join(answers, "rep", "left")
    return made.select("id", "n", "d1", "d2").join(answered, ["d1", "d2", "n"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("root", "rep", "id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).cast("long").alias("n_links"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("n_copies"),
        F.coalesce("set_links", F.lit(0)).cast("long").alias("n_set_links"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One document of each class, the one with the least id, with all its columns.

    Texts that share an id all stay: the class of one says nothing of another.
    """
    rows = similarity_classes(docs, id_col=id_col, text_col=text_col, **settings)
    dropped = rows.where(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias("__dropped")).distinct()
    dropped = dropped.join(ambiguous_ids(docs, id_col, text_col), F.col("__dropped") == F.col("__many"), "left_anti")
    return docs.join(dropped, docs[id_col] == dropped["__dropped"], "left_anti")
