"""Alignment of the tokens of two tokenizers: groups by pointer jumping, links, and how good a link is corpus-wide.

A text with a space before it is encoded by a byte-level BPE (A) and by a piece model (B, which adds that space
itself). Byte offsets where tokens of both end cut the tokens into groups; tokens link that share a group.

**Method.** Tokens of A and B lie on one axis of bytes. Every token points to its farthest-right overlapping token: the
token of the other kind that covers its last byte, or itself where it ends last; of a token of A and one of B that
end together, to B's. Replacing every successor by its successor's successor, for arrays of tokens at once, doubles the reach
until nothing changes; then each token points to the terminal token of its component, which labels its group.

**Words.** Before a space between a character that is no space and the beginning of a word, no token of either
model goes on: the split pattern of A begins a part there, and no piece of B holds a space behind another character (both are checked
when the models are loaded). So texts are cut there, each distinct chunk is encoded and aligned once per worker
(a bounded memory, dropped when full), and a text's groups are those of its chunks.

**Counts.** Distinct links of each document are stored once; a count with partial sums gives the number of documents
of each id pair, and the highest count of each id of A. While the counts measure small they are broadcast as sorted arrays and
looked up where the documents lie; beyond that the links meet them in a join, salted for hot pairs, and are summed per row.

Results by case: null and empty texts, and texts whose tokens do not spell the text (the piece character
U+2581 itself, say), have no tokens: zeros, no groups, and no part in the counts; ties for the highest count are all best;
repeated rows are documents each; an empty table gives an empty table; other columns, whatever their names,
are not read; null ids are passed on. A text without such spaces is one chunk, encoded as a whole.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.config import SizingConfig
from podium.llm.words import text_buffer
from podium.llm.work import stored
from podium.operators.joins import enrich

#: Chunks that a worker remembers, and the longest one that it does.
CHUNKS = 120_000
CHUNK_BYTES = 256
_PIECE = 1 << 20
_JOINED = 1 << 15
_ROWS = 256
_SPACE_PIECE = "▁".encode()

SCHEMA = (
    "id long, n_a long, n_b long, n_groups long, n_links long, groups string, a_ids array<int>, b_ids array<int>, times array<int>"
)
SHIFT = 32
#: Of a count in the broadcast arrays.
COUNT_BYTES = 24


def pointers(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each token of A and of B, numbered from 0, from the byte offsets where tokens end.

    Both lists ascend and end at the same offset.
    """
    n = len(a_end)
    over = np.searchsorted(b_end, a_end)  # the token of B that covers the last byte of each of A
    under = np.searchsorted(a_end, b_end)
    own = np.arange(len(b_end)) + n
    after = np.concatenate([over + n, np.where(a_end[under] > b_end, under, own)])
    while True:
        further = after[after]
        if np.array_equal(further, after):
            break
        after = further
    terminals, group = np.unique(after, return_inverse=True)
    # Terminal tokens are of B, so their order is the order of bytes.
    return group[:n], group[n:]


def _byte_table() -> dict[str, int]:
    """The characters that a byte-level BPE writes for bytes: printable ones as they are, others from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    table = {chr(b): b for b in plain}
    others = [b for b in range(256) if b not in set(plain)]
    return table | {chr(256 + k): b for k, b in enumerate(others)}


class Spelt:
    """The bytes of each id, one after another."""

    def __init__(self, tokens: list[bytes]):
        self.data = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.first = np.cumsum(self.size) - self.size

    def written(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of these ids, one after another."""
        size = self.size[ids]
        return self.data[np.arange(size.sum()) + np.repeat(self.first[ids] - (np.cumsum(size) - size), size)]


class Models:
    """Both tokenizers, with the bytes of each id."""

    def __init__(self, a_model: bytes, b_model: bytes):
        # Spark spreads the work; a task is one thread.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_model.decode())
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        table = _byte_table()
        entries = {i: token for token, i in self.a.get_vocab(with_added_tokens=True).items()}
        written = [entries.get(i, "") for i in range(max(entries) + 1)]
        self.a_bytes = Spelt([bytes(table[c] for c in t) if all(c in table for c in t) else t.encode() for t in written])
        pieces = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = Spelt(pieces)
        #: Each id with the sign behind it: another of its kind, B's ids, the next group.
        self.shown = [f"{i}{sign}" for i in range(max(len(written), len(pieces))) for sign in ",|;"]
        late = [p for p in pieces if b" " in p[1:] and p.strip(b" ")]
        if late or self.a.pre_tokenizer.pre_tokenize_str(" a b.c, d1 é") != [
            (" a".replace(" ", "Ġ"), (0, 2)), ("Ġb", (2, 4)), (".", (4, 5)), ("c", (5, 6)), (",", (6, 7)),
            ("Ġd", (7, 9)), ("1", (9, 10)), ("ĠÃ©", (10, 12)),
        ]:
            raise ValueError("tokens of these models may go on across words")

    def _ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        return list(zip(a, self.b.encode([t[1:] for t in texts], num_threads=1), strict=True))

    def encode(self, chunks: list[bytes], size: np.ndarray) -> tuple[Flat, Flat]:
        """Tokens of A and B. Chunks that may be joined come first and are encoded in texts of about ``_JOINED`` bytes."""
        joint = sum(map(may_join, chunks))
        ends = np.cumsum(size)
        cuts = np.unique(np.searchsorted(ends[:joint], np.arange(0, ends[joint - 1], _JOINED))).tolist() if joint else []
        found: tuple[list, list] = ([], [])
        owners: tuple[list, list] = ([], [])
        for lo, hi in zip(cuts, [*cuts[1:], joint], strict=True):
            whole = b"".join(chunks[lo:hi])
            bounds = ends[lo:hi] - (ends[lo] - size[lo])
            taken = []
            for ids, spelt in zip(self._ids([whole.decode()])[0], (self.a_bytes, self.b_bytes), strict=True):
                ids = np.array(ids, np.int64)
                stops = np.cumsum(spelt.size[ids])
                same = len(ids) and stops[-1] == len(whole) and spelt.written(ids).tobytes() == whole
                if same and np.array_equal(stops[np.searchsorted(stops, bounds)], bounds):
                    taken.append((ids, lo + np.searchsorted(bounds, stops)))
            if len(taken) == 2:
                for k, (ids, owner) in enumerate(taken):
                    found[k].append(ids)
                    owners[k].append(owner)
            else:
                self._singly(chunks, lo, hi, found, owners)
        self._singly(chunks, joint, len(chunks), found, owners)
        return Flat(found[0], owners[0], self.a_bytes), Flat(found[1], owners[1], self.b_bytes)

    def _singly(self, chunks: list[bytes], lo: int, hi: int, found: tuple[list, list], owners: tuple[list, list]) -> None:
        for at, both in enumerate(self._ids([c.decode() for c in chunks[lo:hi]]), lo):
            for k, ids in enumerate(both):
                found[k].append(np.array(ids, np.int64))
                owners[k].append(np.full(len(ids), at))

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:-1], 16)])
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        return self.b.id_to_piece(i).replace("▁", " ").encode()


def _safe() -> tuple[np.ndarray, np.ndarray]:
    """Bytes that may stand before, and behind, a space where texts are cut.

    Behind it no white space may begin: neither ASCII nor one of those that begin with 0xC2, 0xE1, 0xE2 or 0xE3.
    """
    before = np.ones(256, bool)
    before[[0x20]] = False
    after = np.zeros(256, bool)
    after[0x21:0x7F] = True
    after[0xC3:0xF5] = True
    after[[0xE1, 0xE2, 0xE3]] = False
    return before, after


_BEFORE, _AFTER = _safe()


def may_join(chunk: bytes) -> bool:
    """Whether a chunk may stand among others in one text without a token that goes on across its ends."""
    return len(chunk) > 1 and bool(_AFTER[chunk[1]]) and chunk[-1] != 0x20 and _SPACE_PIECE not in chunk


class Flat:
    """The tokens of several chunks of one tokenizer, one after another, and the chunk of each."""

    def __init__(self, ids: list[np.ndarray], owner: list[np.ndarray], spelt: Spelt):
        self.ids = np.concatenate([np.zeros(0, np.int64), *ids])
        self.owner = np.concatenate([np.zeros(0, np.int64), *owner])
        self.spelt = spelt
        self.size = spelt.size[self.ids]

    def spells(self, chunks: list[bytes], size: np.ndarray) -> np.ndarray:
        """Which chunks are the bytes of their tokens, none of them empty."""
        total = np.bincount(self.owner, weights=self.size, minlength=len(chunks)).astype(np.int64)
        good = total == size
        good[self.owner[self.size == 0]] = False
        own = good[self.owner]
        written = np.frombuffer(b"".join([c for c, g in zip(chunks, good.tolist(), strict=True) if g]), np.uint8)
        wrong = np.flatnonzero(self.spelt.written(self.ids[own]) != written)
        of = np.repeat(np.flatnonzero(good), size[good])
        good[of[wrong]] = False
        return good

    def take(self, whole: np.ndarray) -> None:
        """Keep the tokens of these chunks, and tell where each ends on the axis of their bytes."""
        own = whole[self.owner]
        self.ids, self.owner, self.size = self.ids[own], self.owner[own], self.size[own]
        # The kept chunks follow each other without gaps.
        self.ends = np.cumsum(self.size)


class Chunks:
    """Distinct chunks of text that a worker has aligned; flat arrays with offsets."""

    def __init__(self, models: Models):
        self.models = models
        self.forget()

    def forget(self) -> None:
        self.large = False
        self.known: dict[bytes, int] = {}
        self.shown: list[str | None] = []  # the groups; None where the tokens do not spell the chunk
        self.sums = np.zeros((0, 4), np.int64)
        self.pairs = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.hits = np.zeros(0, np.int64)

    def thin(self) -> None:
        """Keep the chunks that came more than once lately, at most half of the memory; the others can be aligned again."""
        chunks = list(self.known)
        size = np.diff(self.first)
        short = np.fromiter(map(len, chunks), np.int64, len(chunks)) <= CHUNK_BYTES
        keep = np.flatnonzero((self.hits > 1) & short & (size <= CHUNK_BYTES))
        keep = np.sort(keep[np.argsort(-self.hits[keep], kind="stable")][: CHUNKS // 2])
        shown, size, sums, hits = self.shown, size[keep], self.sums[keep], self.hits[keep] // 2
        pairs = self.pairs[np.arange(size.sum()) + np.repeat(self.first[keep] - (np.cumsum(size) - size), size)]
        self.forget()
        if pairs.size <= 8 * CHUNKS:
            self.known = {chunks[k]: at for at, k in enumerate(keep.tolist())}
            self.shown = [shown[k] for k in keep.tolist()]
            self.sums, self.pairs, self.hits = sums, pairs, hits
            self.first = np.concatenate([[0], np.cumsum(size)])

    def add(self, chunks: list[bytes]) -> None:
        """Encode and align chunks, each a space and what follows it."""
        m = self.models
        chunks = sorted(chunks, key=may_join, reverse=True)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        self.large |= bool((size > CHUNK_BYTES).any())
        a, b = m.encode(chunks, size)
        whole = a.spells(chunks, size) & b.spells(chunks, size)
        a.take(whole)
        b.take(whole)
        shown: list[str | None] = [None] * len(chunks)
        sums = np.zeros((len(chunks), 4), np.int64)
        pairs = np.zeros(0, np.int64)
        if len(a.ids):
            group_a, group_b = pointers(a.ends, b.ends)
            groups = int(group_b[-1]) + 1
            in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
            owner = np.zeros(groups, np.int64)
            owner[group_a] = a.owner
            # Every token of A with every token of B of its group.
            width = in_b[group_a]
            left = np.repeat(np.arange(len(a.ids)), width)
            right = np.arange(len(left)) - np.repeat(np.cumsum(width) - width, width) + (np.cumsum(in_b) - in_b)[group_a[left]]
            pairs = (a.ids[left] << SHIFT) | b.ids[right]
            sums[:, 0], sums[:, 1] = np.bincount(a.owner, minlength=len(chunks)), np.bincount(b.owner, minlength=len(chunks))
            sums[:, 2] = np.bincount(owner, minlength=len(chunks))
            np.add.at(sums[:, 3], owner, in_a * in_b)
            # Ids in order, A's before B's in each group, each with the sign that follows it.
            group = np.concatenate([group_a, group_b])
            order = np.argsort(2 * group + np.repeat([0, 1], [len(a.ids), len(b.ids)]), kind="stable")
            kind = order >= len(a.ids)
            ids, group = np.concatenate([a.ids, b.ids])[order], group[order]
            last = np.append((group[1:] != group[:-1]) | (kind[1:] != kind[:-1]), True)
            sign = np.where(last, 1 + kind, 0)
            parts = list(map(m.shown.__getitem__, (3 * ids + sign).tolist()))
            stops = np.cumsum(sums[:, 0] + sums[:, 1]).tolist()
            at = 0
            for k in range(len(chunks)):
                if whole[k]:
                    shown[k] = "".join(parts[at : stops[k]])[:-1]
                    at = stops[k]
        known = self.known
        for chunk in chunks:
            known[chunk] = len(known)
        self.shown += shown
        self.sums = np.concatenate([self.sums, sums])
        self.pairs = np.concatenate([self.pairs, pairs])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(sums[:, 3])])
        self.hits = np.concatenate([self.hits, np.zeros(len(chunks), np.int64)])

    def numbers(self, chunks: list[bytes]) -> np.ndarray:
        """The number of each chunk; new ones are aligned together."""
        fresh = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if fresh:
            self.add(fresh)
        found = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        self.hits += np.bincount(found, minlength=len(self.hits))
        return found


_REMEMBERED: dict[tuple[bytes, bytes], Chunks] = {}


def remembered(a_model: bytes, b_model: bytes) -> Chunks:
    """The worker's own chunks of these models; the next task goes on with them."""
    key = (hashlib.sha256(a_model).digest(), hashlib.sha256(b_model).digest())
    if key not in _REMEMBERED:
        _REMEMBERED.clear()
        _REMEMBERED[key] = Chunks(Models(a_model, b_model))
    return _REMEMBERED[key]


def chunk_bounds(data: np.ndarray) -> np.ndarray:
    """Where the chunks of a text begin, and its end; ``data`` begins with the added space."""
    cuts = np.flatnonzero((data[1:-1] == 0x20) & _BEFORE[data[:-2]] & _AFTER[data[2:]]) + 1
    return np.concatenate([[0], cuts, [len(data)]])


def _align(column: pa.Array, chunks: Chunks) -> Iterator[list]:
    """(n_a, n_b, n_groups, n_links, groups, distinct pairs, times) of each text of a column."""
    data, offsets = text_buffer(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _PIECE, "right")) - 1)
        if chunks.large or len(chunks.known) > CHUNKS or len(chunks.pairs) > 16 * CHUNKS:
            chunks.thin()
        parts, counts = [], []
        for i in range(row, stop):
            own = data[offsets[i] : offsets[i + 1]]
            if not len(own):
                counts.append(0)
                continue
            text = b" " + own.tobytes()
            bounds = chunk_bounds(np.frombuffer(text, np.uint8)).tolist()
            parts += [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            counts.append(len(bounds) - 1)
        numbers = chunks.numbers(parts)
        at = 0
        for n in counts:
            own = numbers[at : at + n]
            at += n
            listed = own.tolist()
            shown = list(map(chunks.shown.__getitem__, listed))
            if not n or None in shown:
                yield [0, 0, 0, 0, "", [], []]
                continue
            kinds, often = np.unique(own, return_counts=True)
            sums = often @ chunks.sums[kinds]
            size = chunks.first[kinds + 1] - chunks.first[kinds]
            place = np.arange(size.sum()) + np.repeat(chunks.first[kinds] - (np.cumsum(size) - size), size)
            pairs, which = np.unique(chunks.pairs[place], return_inverse=True)
            times = np.bincount(which, weights=np.repeat(often, size), minlength=len(pairs)).astype(np.int64)
            yield [*sums.tolist(), ";".join(shown), pairs, times]
        row = stop


def _lists(pairs: list, times: list) -> list[pa.Array]:
    """Columns of the ids of A, those of B, and the times."""
    offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
    flat, often = (np.concatenate([np.zeros(0, np.int64), *(np.asarray(v, np.int64) for v in c)]) for c in (pairs, times))
    columns = (flat >> SHIFT, flat & ((1 << SHIFT) - 1), often)
    return [pa.ListArray.from_arrays(offsets, pa.array(c.astype(np.int32))) for c in columns]


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, a_ids, b_ids, times), one row per document.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` in ids; ``a_ids`` and ``b_ids`` are the distinct linked pairs, and
    ``times`` says how often each is linked in the document.
    """
    # The models are read here and shipped, since executors need not see the files.
    with open(a_path, "rb") as a_file, open(b_path, "rb") as b_file:
        shipped = docs.sparkSession.sparkContext.broadcast((a_file.read(), b_file.read()))
    names = [part.strip().split()[0] for part in SCHEMA.split(",") if " " in part.strip()]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = remembered(*shipped.value)
        for batch in (whole.slice(i, _ROWS) for whole in batches for i in range(0, whole.num_rows, _ROWS)):
            rows, begun, size = [], 0, 0

            def packed(rows: list, begun: int) -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True))
                arrays = [batch.column(0).slice(begun, len(rows))]
                arrays += [pa.array(c, pa.int64()) for c in columns[:4]]
                arrays += [pa.array(columns[4], pa.string()), *_lists(columns[5], columns[6])]
                return pa.RecordBatch.from_arrays(arrays, names)

            for row in _align(batch.column(1), chunks):
                rows.append(row)
                size += len(row[4]) + 16 * len(row[5])
                if size > 8 * _PIECE:
                    yield packed(rows, begun)
                    begun, rows, size = begun + len(rows), [], 0
            if rows:
                yield packed(rows, begun)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
    return rows.mapInArrow(over, SCHEMA)


def held_pairs(linked: DataFrame) -> DataFrame:
    """(row, pair, times) of each distinct pair of each document; a pair is ``a << 32 | b``."""
    held = linked.select("row", F.explode(F.arrays_zip("a_ids", "b_ids", "times")).alias("h"))
    pair = F.shiftleft(F.col("h.a_ids").cast("long"), SHIFT).bitwiseOR(F.col("h.b_ids").cast("long"))
    return held.select("row", pair.alias("pair"), F.col("h.times").alias("times"))


def pair_counts(held: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold each id pair, and 1 where no other pair of its id of A is in more.

    Pairs of a single document whose id of A has a better one are left out: theirs are 1 and 0.
    """
    counts = held.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).withColumn("a", F.shiftright("pair", SHIFT))
    counts = stored(counts, "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    best = (F.col("n") == F.col("most")).cast("long")
    return counts.join(most, "a").where("n > 1 or most = 1").select("pair", "n", best.alias("best"))


def summed_here(linked: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents with their sums, looked up in a broadcast of the counts; nothing moves."""
    table = counts.orderBy("pair").toArrow()
    columns = tuple(table[c].combine_chunks().to_numpy() for c in ("pair", "n", "best"))
    shipped = linked.sparkSession.sparkContext.broadcast(columns)

    def of(a: pa.Array, b: pa.Array, times: pa.Array) -> list[np.ndarray]:
        known, n, best = shipped.value
        pair = (a.flatten().to_numpy().astype(np.int64) << SHIFT) | b.flatten().to_numpy()
        often = times.flatten().to_numpy().astype(np.int64)
        # Pairs that are not counted are in one document, and not the best of their id of A.
        place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
        there = known[place] == pair if len(known) else np.zeros(len(pair), bool)
        first = np.concatenate([[0], np.cumsum(times.value_lengths().fill_null(0).to_numpy())])
        found = []
        for values, default in ((best, 0), (n, 1)):
            each = np.full(len(pair), default, np.int64)
            each[there] = values[place[there]]
            total = np.concatenate([[0], np.cumsum(each * often)])
            found.append(total[first[1:]] - total[first[:-1]])
        return found

    def sums(a: pa.Array, b: pa.Array, times: pa.Array) -> pa.Array:
        parts = [of(*(c.slice(i, _ROWS) for c in (a, b, times))) for i in range(0, len(a), _ROWS)]
        columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*parts, strict=True)] or [[], []]
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], ["n_best", "count_sum"])

    sums.__annotations__ = {"a": pa.Array, "b": pa.Array, "times": pa.Array, "return": pa.Array}
    found = F.arrow_udf(sums, "n_best long, count_sum long")("a_ids", "b_ids", "times")
    return linked.withColumn("sums", found).select(*linked.columns, "sums.*")


def summed_by_join(linked: DataFrame, counts: DataFrame, sizing: SizingConfig) -> DataFrame:
    """The documents with their sums, by a join of all pairs with the counts."""
    sums = enrich(held_pairs(linked), counts, "pair", how="left", sizing=sizing).groupBy("row").agg(
        F.sum(F.col("times") * F.coalesce("best", F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.coalesce("n", F.lit(1))).alias("count_sum"),
    )
    return linked.join(sums, "row", "left")


def aligned(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sizing: SizingConfig = SizingConfig(),
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), one row per document.

    ``n_best`` are the links whose pair is in as many documents as any pair of its id of A, ``count_sum`` is the sum, over
    the links, of the documents that hold the pair. The counts are broadcast when they measure less than
    ``sizing`` allows (24 bytes a pair).
    """
    linked = links(docs, a_path, b_path, id_col, text_col)
    linked = stored(linked.withColumn("row", F.monotonically_increasing_id()), "links", compression="zstd")
    counts = stored(pair_counts(held_pairs(linked)), "counts")
    small = counts.count() * COUNT_BYTES <= sizing.broadcast_bytes
    rows = summed_here(linked, counts) if small else summed_by_join(linked, counts, sizing)
    return rows.select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"),
        "groups",
    )
