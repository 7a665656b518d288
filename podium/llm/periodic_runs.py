"""Periodic runs of words: suffix-tree LCE, and Lyndon roots extended to both sides.

A word is a maximal run of characters other than ``\\x20`` and ``\\x09-\\x0D``; words are numbered from 0. A run
is a stretch of words with smallest period q (words q apart are identical) that no neighbouring word extends
with that period, of at least ``min_length`` words and ``min_exponent`` periods.

**Method.** Ukkonen's algorithm builds the suffix tree of the words and of their reversal. A walk round the tree
lists its leaves and the string depth of the branching node passed between neighbours; a sparse table of
least depths over that tour gives the lowest common ancestor's depth, the longest common extension of two
places, in constant time, for whole arrays of places at once. The order of the leaves also gives, for each
place, the next smaller and the next greater suffix: the ends of the longest Lyndon word there in the order of words and
in its inverse. The root of every run is such a word in one of the two orders. Each of these candidates of
length q is extended to the right in the tree, and to the left in the tree of the reversal, and kept when long enough.

**What is handed to the trees.** In a run of four periods and six words or more, each three words in a row occur
at least three times. Stretches that are covered by three-word windows of as many occurrences, found for a
whole batch at once, hold all runs (also the word that could extend one would be covered), so trees
are built of these stretches only; other settings use the number of occurrences that they imply, and whole texts where it is
below two. Only candidates whose extension to the right leaves enough for the wanted exponent need the second tree.

Results by case: null and empty texts, and those of white space, have no words and no runs; runs of different
periods that overlap are all given; equal runs of repeated rows are given for each row; an empty table gives an
empty table; other columns, whatever their names, are not read; null ids are passed on. A text is worked on as
a whole: memory grows with the longest stretch that repeats itself (about 1 KB a word of it). Words are compared by 64-bit
hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.words import mix, pieces

MIN_LENGTH = 6
MIN_EXPONENT = 4
WINDOW = 3
_BASE = 0xD6E8FEB86659FD93

SCHEMA = "id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


# ---- words


def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


_SPACE = _spaces()
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        for k, step in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(max(n, 1 << 21), step, np.uint64)
            factors[0] = 1
            _POWERS[k] = np.cumprod(factors)
    return _POWERS[0][:n], _POWERS[1][:n]


@dataclass(frozen=True)
class Tokens:
    """Words of several texts: their bytes, a hash each, and the first word of each text (and the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``."""
    n = len(data)
    inside = ~_SPACE[data]
    before, after = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    before[1:], after[:n] = inside, inside
    before[offsets] = after[offsets] = False
    start = np.flatnonzero(inside & ~before[:n])
    end = np.flatnonzero(inside & ~after[1:]) + 1
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    # Bytes count from 1, so that a word of NULs differs from a shorter one.
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    hashes = mix((total[end] - total[start]) * down[start])
    return Tokens(start, end, hashes, np.searchsorted(start, offsets))


# ---- stretches that may hold a run


def occurrences(min_length: int, min_exponent: float, window: int = WINDOW) -> int:
    """How often each ``window`` words in a row of a run occur in it, whatever its period."""
    if min_length < window:
        return 1
    periods = range(1, 8 * window + 1)
    return max(1, min((max(min_length, math.ceil(min_exponent * q)) - window + 1) // q for q in periods))


def _frequent(words: np.ndarray, part: np.ndarray, needed: int) -> np.ndarray:
    """Which places begin a window that occurs ``needed`` times in its part; parts are consecutive."""
    n = len(words) - WINDOW + 1
    if n < 1:
        return np.zeros(len(words), bool)
    key = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        key = mix(key ^ words[k : k + n]) + np.uint64(k + 1)
    key = mix(key + part[:n].astype(np.uint64) * np.uint64(_BASE))
    whole = part[:n] == part[WINDOW - 1 :]
    places = np.flatnonzero(whole)
    order = places[np.argsort(key[places], kind="stable")]
    ordered = key[order]
    cuts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, int)
    counts = np.diff(np.append(cuts, len(ordered)))
    found = np.zeros(len(words), bool)
    found[order[np.repeat(counts >= needed, counts)]] = True
    return found


def stretches(words: np.ndarray, first: np.ndarray, min_length: int, min_exponent: float) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the stretches of words that hold all runs, each within one text."""
    begins, ends = first[:-1], first[1:]
    needed = occurrences(min_length, min_exponent)
    while needed > 1:
        size = ends - begins
        part = np.repeat(np.arange(len(begins)), size)
        place = np.arange(len(part)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(begins, size)
        start = place[_frequent(words[place], part, needed)]
        # Windows that begin at neighbouring places of one part belong together.
        owner = np.searchsorted(begins, start, "right")
        fresh = np.append(True, (start[1:] != start[:-1] + 1) | (owner[1:] != owner[:-1])) if len(start) else np.zeros(0, bool)
        cuts = np.flatnonzero(fresh)
        last = np.append(cuts, len(start))[1:] - 1
        found = start[cuts], start[last] + WINDOW
        keep = found[1] - found[0] >= min_length
        found = found[0][keep], found[1][keep]
        if (found[1] - found[0]).sum() == size.sum():
            break
        begins, ends = found
    keep = ends - begins >= min_length
    return begins[keep], ends[keep]


# ---- suffix tree


def _ukkonen(text: list[int], symbols: int) -> tuple[list[int], list[int], dict[int, int]]:
    """(begin of each node's edge, its end, child by ``node * symbols + symbol``); the last symbol must be unique."""
    n = len(text)
    begin, end, link = [0], [0], [0]
    child: dict[int, int] = {}
    find = child.get
    node = edge = length = due = 0
    for i, symbol in enumerate(text):
        due += 1
        waiting = 0
        while due:
            if not length:
                edge = i
            key = node * symbols + text[edge]
            below = find(key)
            if below is None:
                child[key] = len(begin)
                begin.append(i)
                end.append(n)
                link.append(0)
                if waiting:
                    link[waiting] = node
                    waiting = 0
            else:
                at = begin[below]
                span = end[below] - at
                if length >= span:
                    node = below
                    edge += span
                    length -= span
                    continue
                if text[at + length] == symbol:
                    length += 1
                    if waiting:
                        link[waiting] = node
                    break
                middle = len(begin)
                begin += (at, i)
                end += (at + length, n)
                link += (0, 0)
                child[key] = middle
                child[middle * symbols + symbol] = middle + 1
                child[middle * symbols + text[at + length]] = below
                begin[below] = at + length
                if waiting:
                    link[waiting] = middle
                waiting = middle
            due -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - due + 1
    return begin, end, child


class Extensions:
    """Longest common extensions of places of a text, by lowest common ancestors of its suffix tree's leaves."""

    def __init__(self, words: np.ndarray, symbols: int):
        """``words`` are numbers from 1 to ``symbols - 1``."""
        text = [*words.tolist(), 0]
        begin, end, child = _ukkonen(text, symbols)
        n = len(text)
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        del child
        order = np.argsort(keys)
        keys, nodes = keys[order] // symbols, nodes[order]
        bounds = np.searchsorted(keys, np.arange(len(begin) + 1)).tolist()
        nodes = nodes.tolist()
        # Round the tree: leaves in the order of words, and the depth of the node passed before each leaf.
        leaves, tour = [], []
        stack, depths = [0], [0]
        passed = 0
        turned = True
        while stack:
            node, above = stack.pop(), depths.pop()
            if turned:
                passed, turned = above, False
            lo, hi = bounds[node], bounds[node + 1]
            if lo == hi:
                leaves.append(begin[node] - above)
                tour.append(passed)
                turned = True
            else:
                depth = above + end[node] - begin[node]
                stack += nodes[lo:hi][::-1]
                depths += [depth] * (hi - lo)
        self.leaves = np.array(leaves, np.int64)
        self.rank = np.empty(n, np.int64)
        self.rank[self.leaves] = np.arange(n)
        level = np.array(tour, np.int32)
        self.least = [level]
        width = 1
        while 2 * width <= n:
            level = np.minimum(level[:-width], level[width:])
            self.least.append(level)
            width *= 2

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``a`` and ``b``, different places each."""
        a, b = self.rank[a], self.rank[b]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own = level == k
            out[own] = np.minimum(self.least[k][lo[own]], self.least[k][hi[own] - (1 << k)])
        return out


def _next_less(rank: list[int]) -> list[int]:
    """For each place the next one of a smaller rank, or the length."""
    n = len(rank)
    out = [n] * n
    open_: list[int] = []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs_in(words: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: float = MIN_EXPONENT) -> np.ndarray:
    """Rows (start, length, period) of the runs of one stretch of words, sorted."""
    n = len(words)
    none = np.zeros((0, 3), np.int64)
    if n < min_length:
        return none
    _, codes = np.unique(words, return_inverse=True)
    codes = codes.astype(np.int64) + 1
    symbols = int(codes.max()) + 1
    ahead = Extensions(codes, symbols)
    # The empty suffix is the least in the order of words and the greatest in its inverse.
    rank = ahead.rank[:n].tolist()
    near = np.array(_next_less(rank), np.int64)
    far = np.array(_next_less([-r for r in rank]), np.int64)
    place = np.concatenate([np.arange(n), np.arange(n)])
    other = np.concatenate([near, far])
    own = other < n
    place, other = place[own], other[own]
    period = other - place
    right = ahead.common(place, other)
    # Some root of a run lies in its first period: from there the rest of the run extends to the right.
    own = right >= np.ceil(np.maximum(min_exponent, 2) * period) - 2 * period
    place, other, period, right = place[own], other[own], period[own], right[own]
    if not len(place):
        return none
    del ahead
    back = np.zeros(len(place), np.int64)
    inner = np.flatnonzero(place > 0)
    if len(inner):
        behind = Extensions(codes[::-1], symbols)
        back[inner] = behind.common(n - place[inner], n - other[inner])
    length = back + period + right
    own = length >= np.maximum(np.maximum(min_length, np.ceil(min_exponent * period)), 2 * period)
    found = np.stack([place - back, length, period], axis=1)[own]
    return np.unique(found[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]


# ---- tables


def _judged(data: np.ndarray, offsets: np.ndarray, min_length: int, min_exponent: float):
    """(number of words, runs, text without repeated periods) of each text."""
    tokens = tokens_of(data, offsets)
    n = np.diff(tokens.first)
    found: dict[int, list[np.ndarray]] = {}
    change = np.zeros(len(tokens.start) + 1, np.int64)
    begins, ends = stretches(tokens.hash, tokens.first, min_length, min_exponent)
    owners = np.searchsorted(tokens.first, begins, "right") - 1
    for text, begin, end in zip(owners.tolist(), begins.tolist(), ends.tolist(), strict=True):
        runs = runs_in(tokens.hash[begin:end], min_length, min_exponent)
        if len(runs):
            runs[:, 0] += begin
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 0] + runs[:, 1], -1)
            runs[:, 0] -= tokens.first[text]
            found.setdefault(text, []).append(runs)
    dropped = np.cumsum(change)[:-1] > 0
    # The words that stay, each with a space behind it, gathered in one step.
    start, size = tokens.start[~dropped], (tokens.end - tokens.start)[~dropped] + 1
    stops = np.cumsum(size)
    place = np.arange(stops[-1] if len(stops) else 0) + np.repeat(start - (stops - size), size)
    joined = np.append(data, np.uint8(0x20))[np.minimum(place, len(data))]
    joined[stops - 1] = 0x20
    stays = np.concatenate([[0], np.cumsum(~dropped)])[tokens.first]
    edges = np.concatenate([[0], stops])[stays]
    collapsed = [joined[a : max(a, b - 1)].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    runs_of = [np.concatenate(found[i]) if i in found else None for i in range(len(n))]
    return n, runs_of, collapsed


def _runs_array(runs_of: list[np.ndarray | None]) -> pa.Array:
    size = [0 if runs is None else len(runs) for runs in runs_of]
    flat = np.concatenate([np.zeros((0, 3), np.int64), *(runs for runs in runs_of if runs is not None)])
    fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), fields)


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: float = MIN_EXPONENT,
) -> DataFrame:
    """(id, n_words, runs, collapsed), one row per document.

    ``runs`` holds (start, length, period) by start, then period. ``collapsed`` are the words joined by one space,
    without those that a run contains after its first period.
    """
    if min_exponent < 2:
        raise ValueError(f"a run has two periods at least: {min_exponent}")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in pieces(batch.column(1)):
                n, runs_of, collapsed = _judged(data, offsets, min_length, min_exponent)
                texts = pa.array(collapsed, pa.binary()).cast(pa.string())
                ids = batch.column(0).slice(row, len(n))
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), _runs_array(runs_of), texts], names)

    names = ["id", "n_words", "runs", "collapsed"]
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(over, SCHEMA).withColumnRenamed("id", id_col)
