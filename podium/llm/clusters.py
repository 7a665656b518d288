"""Exact similarity within candidate clusters of sets.

Candidates come as clusters of representatives. The members' sets are gathered cluster by cluster, each
cluster in blocks of bounded size, and every pair of a cluster is compared exactly: the sizes of all
intersections of two blocks are one product of 0/1 matrices over the values that occur twice there. Pairs
are counted and joined to trees where they are found, so what leaves a task is at most one row per member.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.work import map_groups

#: Members, and values of their sets together, of one block; a task holds two blocks.
BLOCK_MEMBERS = 1024
BLOCK_VALUES = 1 << 20
_CHUNK = 1 << 12


def overlaps(values: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sorted sets."""
    sizes = [len(v) for v in values]
    if len(values) == 2:
        shared = len(np.intersect1d(values[0], values[1], assume_unique=True))
        return np.array([[sizes[0], shared], [shared, sizes[1]]])
    row = np.repeat(np.arange(len(values)), sizes)
    _, column, times = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1
    kept = times[column] > 1
    row, column = row[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(values), len(values)), np.float32)
    width = max(64, min(_CHUNK, (1 << 24) // len(values)))
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, (begin, begin + width))
        part = np.zeros((len(values), width), np.float32)
        part[row[lo:hi], column[lo:hi] - begin] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def similar(values: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have Jaccard similarity of the threshold or more; not of a set with itself."""
    sizes = np.array([len(v) for v in values])
    shared = overlaps(values)
    found = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    np.fill_diagonal(found, False)
    return found


def roots(linked: np.ndarray) -> np.ndarray:
    """The first member that each member is connected with."""
    label = np.arange(len(linked))
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], len(label)).min(1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


def tasks(members: DataFrame) -> DataFrame:
    """(task, id, weight, part, parts): members (cluster, id, weight, n) dealt to pairs of blocks.

    A cluster that fits one block is one task. A larger one is split by a hash of the id, and each pair of
    its blocks is a task; ``part`` tells on which side a member stands (0 both, 1 left, 2 right).
    """
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("values"))
    sizes = sizes.where("m > 1").select(
        "cluster", F.greatest(F.ceil(F.col("m") / BLOCK_MEMBERS), F.ceil(F.col("values") / BLOCK_VALUES)).cast("int").alias("blocks")
    )
    rows = members.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    part = F.when(low == high, 0).when(F.col("own") == low, 1).otherwise(2)
    return rows.select(F.xxhash64("cluster", low, high).alias("task"), "id", "weight", part.cast("int").alias("part"))


def links(gathered: DataFrame, threshold: float) -> DataFrame:
    """(id, root, links, set_links) per task and member, from rows (task, id, weight, part, values).

    ``links`` adds up the weights of the sets linked with a member, ``set_links`` counts them, and ``root``
    is the least member of the task that it is connected with.
    """

    def over(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks().sort_by("id")
        _, first = np.unique(rows["id"].to_numpy(), return_index=True)
        rows = rows.take(first)
        ids = rows["id"].to_numpy()
        weight = rows["weight"].to_numpy()
        part = rows["part"].to_numpy()
        linked = similar([np.frombuffer(v.as_py(), np.uint64) for v in rows["values"]], threshold)
        if part.any():
            linked &= part[:, None] != part[None, :]
        return pa.table(
            {"id": ids, "root": ids[roots(linked)], "links": linked @ weight, "set_links": linked.sum(1)}
        )

    return map_groups(gathered, "task", over, "id long, root long, links long, set_links long")


def packed_sets(values: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
    for begin, end in zip(offsets[:-1], offsets[1:], strict=True):
        yield values[begin:end].tobytes()
