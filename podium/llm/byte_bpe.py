"""Byte-level BPE encoding and decoding.

**Encoding.** The split pattern cuts a text into words; the merges of a rank file are compiled into
finite-state transducers. The last token of the encoding of a prefix is fixed by the prefix alone, and two
neighbouring tokens stand together exactly if encoding their joined bytes gives them back. The first
transducer reads a word byte by byte, left to right; its state is the longest end of what was read that
begins some token, and a hop gives the tokens that may end there. The second takes of these the longest
that stands together with the last token before it. The third reads the last tokens off from right to
left. One machine for all three would need a state for every set of earlier tokens, nearly one per
prefix. States and hops are built when first met and dropped together when there are too many. In long
words, tokens are settled part by part, as soon as all places agree where a token could still begin. A
word's cost grows with its length, also for one endless word.

**Decoding** looks bytes up and follows an incremental UTF-8 state machine from token to token, so that
characters spread over several tokens, or over two calls, are judged without joining the text.

Both work per row on whole texts, without a shuffle. Results by case: null and empty texts have no ids
and decode to no bytes; special tokens are ordinary text; repeated rows are encoded each; an empty table
gives an empty table; other columns of the input, whatever their names, are not read. Ids outside the
vocabulary raise an error on decoding.
"""

from __future__ import annotations

import base64
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import groupby, islice, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ranks are sent to every executor; a larger file is refused.
MAX_RANK_BYTES = 64 << 20
#: What a worker remembers at most; beyond, it forgets and goes on.
MAX_STATES = 120_000
MAX_PAIRS = 400_000
MAX_WORDS = 300_000
OUT_ROWS = 256
#: Of a longer word, tokens are settled after so many bytes each.
PART_BYTES = 1 << 16

_NONE = 1 << 30
#: Stands for the token before a word's first.
_FIRST = (1 << 32) - 1


@cache
def _spelled_out(pattern: str) -> re.Pattern | None:
    """The split pattern in classes of the standard module, twice as fast, for texts without characters beyond U+FFFF.

    The standard module knows no Unicode properties, and its ``\\s`` has U+001C to U+001F as well.
    """

    def ranges(initial: str) -> str:
        wanted = (i for i in range(0x10000) if unicodedata.category(chr(i))[0] == initial)
        runs = [list(run) for _, run in groupby(enumerate(wanted), lambda pair: pair[1] - pair[0])]
        return "".join(f"{chr(run[0][1])}-{chr(run[-1][1])}" for run in runs)

    space = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    letters, numbers = ranges("L"), ranges("N")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letters}{numbers}]")
    for plain, spelled in ((r"\p{L}", letters), (r"\p{N}", numbers), (r"\s", space), (r"\S", f"^{space}")):
        pattern = pattern.replace(plain, f"[{spelled}]")
    return None if r"\p" in pattern else re.compile(pattern)


class _State(dict):
    """The longest end of what was read that begins some token, as a node of the vocabulary trie.

    Maps a byte to the next state and the tokens that may end there, longest first and the shortest by itself;
    hops are built when asked for.
    """

    __slots__ = ("longer", "machine", "node", "shortest")

    def __init__(self, machine: Transducer, node: int) -> None:
        self.machine, self.node = machine, node
        self.longer, self.shortest = (), -1

    def __missing__(self, byte: int) -> tuple[_State, tuple[int, ...], int]:
        hop = self[byte] = self.machine._hop(self.node, byte)
        return hop


class Transducer:
    """The merges as transducers from bytes to token ids, built as words ask for them."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES) -> None:
        self.ranks = ranks
        self.bytes_of: dict[int, bytes] = {rank: token for token, rank in ranks.items()}
        self._size = {rank: len(token) for token, rank in ranks.items()}
        # A trie of the tokens that merges alone form: node and byte to node, and the token that ends at a node.
        self._step: dict[int, int] = {}
        self._token, self._depth = [-1], [0]
        for token, rank in ranks.items():
            if self.merge(token) != [rank]:
                continue
            node = 0
            for depth, byte in enumerate(token, 1):
                node = self._step.setdefault(node << 8 | byte, len(self._token))
                if node == len(self._token):
                    self._token.append(-1)
                    self._depth.append(depth)
            self._token[node] = rank
        # The node of a node's longest proper end in the trie.
        self._end = [0] * len(self._token)
        for key, node in sorted(self._step.items(), key=lambda item: self._depth[item[1]]):
            if key >> 8:
                self._end[node] = self._next(self._end[key >> 8], key & 255)
        self.max_states = max_states
        self._pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.root = _State(self, 0)
        self._states = {0: self.root}

    def merge(self, word: bytes) -> list[int]:
        """The definition: join the neighbours of lowest rank, leftmost first, until none can be joined."""
        parts = [word[i : i + 1] for i in range(len(word))]
        get = self.ranks.get
        ranks = [get(a + b, _NONE) for a, b in pairwise(parts)]
        while ranks and (least := min(ranks)) != _NONE:
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = get(parts[i - 1] + parts[i], _NONE)
            if i < len(ranks):
                ranks[i] = get(parts[i] + parts[i + 1], _NONE)
        return [self.ranks[part] for part in parts]

    def _together(self, pair: int) -> bool:
        """Whether two tokens may stand side by side; every token may begin a word."""
        left, right = pair >> 32, pair & _FIRST
        if len(self._pairs) >= MAX_PAIRS:
            self._pairs.clear()
        known = self._pairs[pair] = (
            left == _FIRST or self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
        )
        return known

    def _next(self, node: int, byte: int) -> int:
        while (found := self._step.get(node << 8 | byte)) is None and node:
            node = self._end[node]
        return found or 0

    def _hop(self, node: int, byte: int) -> tuple[_State, tuple[int, ...], int]:
        node = self._next(node, byte)
        state = self._states.get(node)
        if state is None:
            if len(self._states) >= self.max_states:
                self._reset()
            state = self._states[node] = _State(self, node)
            tokens = []
            while node:
                if self._token[node] >= 0:
                    tokens.append(self._token[node])
                node = self._end[node]
            state.longer, state.shortest = tuple(tokens[:-1]), tokens[-1] if tokens else -1
        if state.shortest < 0:
            raise ValueError(f"no token ends with byte {byte} here")
        return state, state.longer, state.shortest

    def _settled(self, state: _State, lasts: list[int]) -> int:
        """Where the ways back from all places meet at which a token may yet begin: tokens up to there stay."""
        here, node = len(lasts) - 1, state.node
        places = {here}
        while node:
            places.add(here - self._depth[node])
            node = self._end[node]
        while len(places) > 1:
            places.remove(end := max(places))
            places.add(end - self._size[lasts[end]])
        return places.pop()

    def _back(self, lasts: list[int], end: int) -> list[int]:
        """The tokens up to a place, read off from the last one back."""
        out = []
        while end:
            token = lasts[end]
            out.append(token)
            end -= self._size[token]
        return out[::-1]

    def encode(self, word: bytes) -> list[int]:
        """Token ids of one word."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        # Of each prefix from the last settled place on: the last token.
        state, out, lasts = self.root, [], [_FIRST]
        size, known, add = self._size, self._pairs.get, lasts.append
        for begin in range(0, len(word), PART_BYTES):
            if begin:
                settled = self._settled(state, lasts)
                out += self._back(lasts, settled)
                del lasts[:settled]
            for n, byte in enumerate(word[begin : begin + PART_BYTES], len(lasts)):
                state, longer, last = state[byte]
                for token in longer:
                    pair = lasts[n - size[token]] << 32 | token
                    together = known(pair)
                    if together or together is None and self._together(pair):
                        last = token
                        break
                add(last)
        return out + self._back(lasts, len(lasts) - 1)


class Encoder(dict):
    """Texts to ids as little-endian unsigned 32-bit integers; remembers short words, up to a number.

    Half of them are the latest; of the half before, words that come again go over to these.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        super().__init__()
        self.transducer = Transducer(ranks)
        self.pattern, self.plain = regex.compile(pattern), _spelled_out(pattern)
        self.before: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            found = self.transducer.encode(word.encode())
            ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= 64:
            if len(self) >= MAX_WORDS // 2:
                self.before = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if len(text) < 1 << 22:
            narrow = self.plain and len(text.encode("utf-16-le")) == 2 * len(text)
            return b"".join(map(self.__getitem__, (self.plain if narrow else self.pattern).findall(text)))
        words = (match.group() for match in self.pattern.finditer(text))
        parts = []
        while part := b"".join(map(self.__getitem__, islice(words, 1 << 16))):
            parts.append(part)
        return b"".join(parts)


# States of the UTF-8 machine: between characters; 1, 2 or 3 bytes to come; the four lead bytes
# whose next byte has narrower bounds (E0, ED, F0, F4); ill-formed.
READY, ONE, TWO, THREE, AFTER_E0, AFTER_ED, AFTER_F0, AFTER_F4, ILL = range(9)
_NEXT = {
    ONE: (0x80, 0xBF, READY), TWO: (0x80, 0xBF, ONE), THREE: (0x80, 0xBF, TWO),
    AFTER_E0: (0xA0, 0xBF, ONE), AFTER_ED: (0x80, 0x9F, ONE),
    AFTER_F0: (0x90, 0xBF, TWO), AFTER_F4: (0x80, 0x8F, TWO),
}


def utf8_step(state: int, byte: int) -> int:
    if state == READY:
        if byte < 0x80:
            return READY
        if byte < 0xC2 or byte > 0xF4:
            return ILL
        special = {0xE0: AFTER_E0, 0xED: AFTER_ED, 0xF0: AFTER_F0, 0xF4: AFTER_F4}
        return special.get(byte, ONE if byte < 0xE0 else TWO if byte < 0xF0 else THREE)
    low, high, target = _NEXT.get(state, (1, 0, ILL))
    return target if low <= byte <= high else ILL


class Decoder:
    """Ids to bytes; ``state`` carries an unfinished character from one call to the next."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.simple = np.zeros(size, bool)
        for rank, token in enumerate(self.tokens):
            state = READY
            for byte in token or b"\xff":
                state = utf8_step(state, byte)
            self.simple[rank] = state == READY
        self._hops: dict[tuple[int, int], int] = {}

    def _hop(self, state: int, token: int) -> int:
        known = self._hops.get((state, token))
        if known is None:
            known = state
            for byte in self.tokens[token]:
                known = utf8_step(known, byte)
            self._hops[state, token] = known
        return known

    def decode(self, packed: bytes, state: int = READY) -> tuple[bytes, int]:
        """(bytes, state afterwards) of packed ids."""
        ids = np.frombuffer(packed, "<u4")
        if len(ids) and int(ids.max()) >= len(self.tokens):
            raise ValueError(f"no token has the id {int(ids.max())}")
        out = b"".join(map(self.tokens.__getitem__, ids.tolist()))
        expected = 0
        for i in np.flatnonzero(~self.simple[ids]).tolist():
            if i > expected and state != READY:
                return out, ILL
            state = self._hop(state, int(ids[i]))
            if state == ILL:
                return out, ILL
            expected = i + 1
        return out, state if expected == len(ids) or state == READY else ILL


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in raw.splitlines() if line)}


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file, from the driver's disk or, with a scheme, from a store that Spark reads."""
    if "://" in path:
        size, raw = spark.read.format("binaryFile").load(path).select("length", "content").first()
    else:
        raw = Path(path).read_bytes()
        size = len(raw)
    if size > MAX_RANK_BYTES:
        raise ValueError(f"the rank file has {size} bytes; at most {MAX_RANK_BYTES} are sent to executors")
    return bytes(raw)


@cache
def _encoder(raw: bytes, pattern: str) -> Encoder:
    return Encoder(parse_ranks(raw), pattern)


@cache
def _decoder(raw: bytes) -> Decoder:
    return Decoder(parse_ranks(raw))


def _id_type(rows: DataFrame, id_col: str) -> str:
    return rows.schema[id_col].dataType.simpleString()


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that the ids of one are all that a worker holds besides its input."""
    for batch in batches:
        for begin in range(0, batch.num_rows, OUT_ROWS):
            yield batch.slice(begin, OUT_ROWS)


def _encoded(encoder: Encoder, texts: pa.Array) -> list[pa.Array]:
    packed = [encoder.encode(text) for text in texts.to_pylist()]
    return [pa.array([len(ids) // 4 for ids in packed], pa.int64()), pa.array(packed, pa.binary())]


def _decoded(decoder: Decoder, packed: pa.Array) -> list[pa.Array]:
    found = [decoder.decode(ids or b"") for ids in packed.to_pylist()]
    return [pa.array([f[0] for f in found], pa.binary()), pa.array([f[1] == READY for f in found], pa.bool_())]


_IDS = "n_tokens long, ids binary"
_TEXTS = "decoded binary, well_formed boolean"


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_tokens, ids): the ids of each whole text, packed as little-endian unsigned 32-bit integers."""
    raw = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, ranks_path))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, pattern)
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), *_encoded(encoder, batch.column(1))], names)

    names = [id_col, "n_tokens", "ids"]
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(over, f"`{id_col}` {_id_type(docs, id_col)}, {_IDS}")


def decode(tokens: DataFrame, ranks_path: str, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with ``decoded`` (bytes) and ``well_formed`` (whether they are whole UTF-8)."""
    raw = tokens.sparkSession.sparkContext.broadcast(read_ranks(tokens.sparkSession, ranks_path))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(raw.value)
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns, *_decoded(decoder, batch.column(2))], names)

    names = [id_col, "n_tokens", "ids", "decoded", "well_formed"]
    rows = tokens.select(id_col, "n_tokens", "ids")
    return rows.mapInArrow(over, f"`{id_col}` {_id_type(tokens, id_col)}, {_IDS}, {_TEXTS}")


def round_trip(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``decode(encode(docs))`` by one worker per task."""
    raw = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, ranks_path))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(raw.value, pattern), _decoder(raw.value)
        for batch in _slices(batches):
            encoded = _encoded(encoder, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *encoded, *_decoded(decoder, encoded[1])], names)

    names = [id_col, "n_tokens", "ids", "decoded", "well_formed"]
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(over, f"`{id_col}` {_id_type(docs, id_col)}, {_IDS}, {_TEXTS}")
