"""Secret scans: base patterns, and a character convolutional network over every candidate in its context.

Base findings are exact: ``assign`` (a keyword, a separator and a value of 8 or more characters),
``access`` (AKIA and capitals or digits, 16 or more) and ``hex`` (32 or more lower-case hex digits), leftmost
and not overlapping within a kind. Spans count code points, the end is exclusive.

Further candidates are all runs of 8 or more characters of ``[A-Za-z0-9+/_.=-]``, after the base findings were cut
out of them. The network reads a window of fixed length, the context to the left, the candidate and the context to the
right; over a candidate of more than 48 characters the window slides by 16, so that any 32 characters in a row are
read together, and its highest score counts. Characters become embeddings, a bank of
filters of width 5 slides over them, the strongest answers go to a logistic unit. It is trained in numpy by Adam
on labelled findings, that is base findings of a bounded sample of texts against the other runs there, shorter and
longer ones alike. In
half of the training examples the context is blanked, so that the run itself must tell, and in a quarter the run is
in upper case, in either class. A held-back third
calibrates the scores (a logistic curve) and sets the threshold: the highest score that still recalls the
share ``recall`` of the held-back findings. Candidates stand beside no keyword, so of an ``assign`` finding the network
is given the value alone, keyword, separator and quotes cut out of its context. Candidates that reach the threshold
become ``network`` spans; base spans always stay.

Texts are scanned whole and once, per row, without a shuffle. Results by case: null and empty texts have
no spans; keywords match in either case, in ASCII letters only; equal runs are found at each place; a
sample without findings of one kind gives a network that adds nothing; repeated rows are scanned each;
an empty table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.words import mix
from podium.llm.work import stored

# The base patterns.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "network")

_KEYWORDS = ("password", "passwd", "secret", "token", "api")
MIN_RUN = 8

#: Findings, other runs under ``LONG`` characters and other runs from ``LONG`` on that the network is trained on at most, each.
SAMPLE = 3_000
LONG = 16
LEFT, BODY, RIGHT = 24, 48, 8
WINDOW = LEFT + BODY + RIGHT
STEP = 16
#: Windows that are scored together.
SCORED = 1 << 16
EMBED, FILTERS, WIDTH = 8, 16, 5

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base findings, by start and then by kind."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in _KEYWORDS):
        spans += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def _classes() -> np.ndarray:
    """Character classes of the network: 0 nothing, 1-95 printable ASCII, 96 white space, 97 anything else."""
    table = np.full(128, 97, np.uint8)
    table[0x21:0x7F] = np.arange(1, 0x7F - 0x20)
    table[[9, 10, 13, 32]] = 96
    return table


_CLASSES = _classes()
#: The class of the upper-case letter.
_UPPER = np.arange(98, dtype=np.uint8)
_UPPER[_CLASSES[0x61:0x7B]] = _CLASSES[0x41:0x5B]
_IN_RUN = np.zeros(128, bool)
_IN_RUN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def other_runs(text: str, found: list[Span]) -> np.ndarray:
    """Candidates beside the base findings, as rows (start, end)."""
    codes = _codes(text)
    inside = np.zeros(len(codes) + 2, bool)
    inside[1:-1] = _IN_RUN[np.minimum(codes, 127)] & (codes < 128)
    for start, end, _ in found:
        inside[start + 1 : end + 1] = False
    turns = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2)
    return turns[turns[:, 1] - turns[:, 0] >= MIN_RUN]


def windows(text: str, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, character classes of the context and the run) of each window; a run that is too long for one has more."""
    start, end = np.asarray(runs, np.int64).reshape(-1, 2).T
    n = 1 + np.maximum(0, -(-(end - start - BODY) // STEP))
    row = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    last = place == n[row] - 1
    at = np.where(last, np.maximum(end[row] - BODY, start[row]), start[row] + place * STEP)
    stop = np.minimum(at + BODY, end[row])
    codes = _codes(text)
    classes = np.zeros(LEFT + len(codes) + BODY + RIGHT, np.uint8)
    classes[LEFT : LEFT + len(codes)] = np.where(codes < 128, _CLASSES[np.minimum(codes, 127)], 97)
    body = at[:, None] + np.arange(BODY)
    out = np.zeros((len(row), WINDOW), np.uint8)
    out[:, :LEFT] = classes[at[:, None] + np.arange(LEFT)]
    out[:, LEFT : LEFT + BODY] = np.where(body < stop[:, None], classes[LEFT + body], 0)
    out[:, LEFT + BODY :] = classes[LEFT + stop[:, None] + np.arange(RIGHT)]
    return row, out


@dataclass
class Network:
    """``score`` of a window is the calibrated chance that the candidate is a secret."""

    embed: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    threshold: float = 2.0

    @classmethod
    def new(cls, random: np.random.Generator) -> Network:
        return cls(
            random.normal(0, 0.3, (98, EMBED)), random.normal(0, 0.2, (WIDTH * EMBED, FILTERS)),
            np.zeros(FILTERS), random.normal(0, 0.2, 2 * FILTERS), np.zeros(1),
        )

    def forward(self, windows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logits, and what the way back needs. Strongest and mean answers of each filter are read."""
        places = WINDOW - WIDTH + 1
        chars = self.embed[windows]
        slid = np.lib.stride_tricks.sliding_window_view(chars, WIDTH, axis=1)
        patches = slid.transpose(0, 1, 3, 2).reshape(len(windows), places, WIDTH * EMBED)
        answers = np.maximum(patches @ self.filters + self.filter_bias, 0)
        best = answers.argmax(1)
        strongest = np.take_along_axis(answers, best[:, None, :], 1)[:, 0, :]
        read = np.concatenate([strongest, answers.mean(1)], 1)
        return read @ self.out + self.out_bias[0], (patches, answers, best, read)

    def backward(self, windows: np.ndarray, kept: tuple, error: np.ndarray) -> list[np.ndarray]:
        patches, answers, best, read = kept
        places = answers.shape[1]
        back = error[:, None] * self.out[None, :]
        into = np.repeat(back[:, None, FILTERS:] / places, places, 1)
        rows, columns = np.indices(best.shape)
        into[rows, best, columns] += back[:, :FILTERS]
        into *= answers > 0
        into_patches = (into @ self.filters.T).reshape(len(windows), places, WIDTH, EMBED)
        into_embed = np.zeros_like(self.embed)
        for k in range(WIDTH):
            np.add.at(into_embed, windows[:, k : k + places], into_patches[:, :, k])
        flat = patches.reshape(-1, WIDTH * EMBED)
        return [
            into_embed, flat.T @ into.reshape(-1, FILTERS), into.sum((0, 1)), read.T @ error, np.array([error.sum()]),
        ]

    def score(self, windows: np.ndarray) -> np.ndarray:
        """As ``forward``, with what each character adds to each filter looked up instead of multiplied out."""
        places = WINDOW - WIDTH + 1
        added = [(self.embed @ self.filters[k * EMBED : (k + 1) * EMBED]).astype(np.float32) for k in range(WIDTH)]
        added[0] += self.filter_bias.astype(np.float32)
        logits = np.zeros(len(windows))
        for i in range(0, len(windows), 256):
            own = windows[i : i + 256]
            answers = added[0][own[:, :places]]
            for k in range(1, WIDTH):
                answers += added[k][own[:, k : k + places]]
            np.maximum(answers, 0, out=answers)
            logits[i : i + 256] = np.concatenate([answers.max(1), answers.mean(1)], 1) @ self.out + self.out_bias[0]
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.shift, -500, 500)))


def fit(
    positive: np.ndarray, negative: np.ndarray, recall: float = 0.99, epochs: int = 12, least_steps: int = 400, seed: int = 3
) -> Network:
    """Train on windows of findings and of other runs; a small sample is gone through more often."""
    random = np.random.default_rng(seed)
    net = Network.new(random)
    if len(positive) < 3 or len(negative) < 3:
        return net
    windows = np.concatenate([positive, negative])
    labels = np.concatenate([np.ones(len(positive)), np.zeros(len(negative))])
    order = random.permutation(len(windows))
    held, learn = order[: len(order) // 3], order[len(order) // 3 :]
    share = labels[learn].mean()
    weight = np.where(labels > 0, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    blank = np.zeros(WINDOW, bool)
    blank[:LEFT] = blank[LEFT + BODY :] = True
    names = ("embed", "filters", "filter_bias", "out", "out_bias")
    moments = [[np.zeros_like(getattr(net, name)) for name in names] for _ in range(2)]
    step, batches = 0, max(1, len(learn) // 64)
    for _ in range(max(epochs, -(-least_steps // batches))):
        for batch in np.array_split(random.permutation(learn), batches):
            own = windows[batch].copy()
            own[np.ix_(random.random(len(own)) < 0.5, blank)] = 0
            raised = np.ix_(random.random(len(own)) < 0.25, ~blank)
            own[raised] = _UPPER[own[raised]]
            logits, kept = net.forward(own)
            error = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[batch]) * weight[batch] / len(batch)
            step += 1
            for k, (name, slope) in enumerate(zip(names, net.backward(own, kept, error), strict=True)):
                moments[0][k] = 0.9 * moments[0][k] + 0.1 * slope
                moments[1][k] = 0.999 * moments[1][k] + 0.001 * slope**2
                change = moments[0][k] / (1 - 0.9**step) / (np.sqrt(moments[1][k] / (1 - 0.999**step)) + 1e-8)
                setattr(net, name, getattr(net, name) - 0.005 * change)
    if len(set(labels[held])) < 2:
        return net
    logits = net.forward(windows[held])[0]
    at = np.array([1.0, 0.0])
    x = np.stack([logits, np.ones(len(logits))], 1)
    n_pos, n_neg = labels[held].sum(), (1 - labels[held]).sum()
    goal = np.where(labels[held] > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))

    def loss(at: np.ndarray) -> float:
        return float((np.logaddexp(0, x @ at) - goal * (x @ at)).sum() + 5e-4 * at @ at)

    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        curvature = x.T @ (x * (chance * (1 - chance))[:, None]) + 1e-3 * np.eye(2)
        move = np.linalg.solve(curvature, x.T @ (chance - goal) + 1e-3 * at)
        # Classes that lie far apart make whole steps overshoot.
        part = next((0.5**k for k in range(30) if loss(at - 0.5**k * move) <= loss(at)), 0.0)
        at = at - part * move
    net.slope, net.shift = float(at[0]), float(at[1])
    found = np.sort(net.score(windows[held][labels[held] > 0]))
    net.threshold = float(found[int((1 - recall) * len(found))])
    return net


def finding_windows(text: str, found: list[Span]) -> np.ndarray:
    """Windows of the base findings as candidates would look: values without their keyword."""
    out = [np.zeros((0, WINDOW), np.uint8)]
    values = []
    for start, end, kind in found:
        if kind == 0:
            match = ASSIGN.match(text, start)
            value, quote = match.group(2), text[match.start(2) - 1]
            values.append((start, end))
            after = end + (quote in "\"'" and text[end : end + 1] == quote)
            before = text[max(0, start - LEFT) : start]
            out.append(windows(before + value + text[after : after + RIGHT], [(len(before), len(before) + len(value))])[1])
    # What lies in a value stands beside its keyword, and is read with the value.
    own = [(start, end) for start, end, kind in found if kind and not any(b < end and start < e for b, e in values)]
    out.append(windows(text, own)[1])
    return np.concatenate(out)


def _places(chars: np.ndarray) -> np.ndarray:
    """A hash of each window."""
    out = np.zeros(len(chars), np.uint64)
    for part in np.ascontiguousarray(chars).view("<u8").T:
        out = mix(out ^ part)
    return out


def train(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Network:
    """Fit on labelled findings: at most ``sample`` windows of either class (others: short and long ones), the first by a hash of the window."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A window that is among the first of the whole table is among the first of its task.
        kept = [(np.zeros(0, np.uint64), np.zeros((0, WINDOW), np.uint8))] * 3
        for batch in batches:
            new: tuple[list, ...] = ([], [], [])
            for i, text in enumerate(batch.column(0).to_pylist()):
                found = base_spans(text or "")
                runs = other_runs(text or "", found)
                long = runs[:, 1] - runs[:, 0] >= LONG
                new[1].append(finding_windows(text or "", found))
                new[0].append(windows(text or "", runs[~long])[1])
                new[2].append(windows(text or "", runs[long])[1])
                if i % 256 == 255 or i == batch.num_rows - 1:
                    kept = [first(*k, np.concatenate(n)) for k, n in zip(kept, new, strict=True)]
                    new = ([], [], [])
        for label, (place, chars) in enumerate(kept):
            columns = [np.full(len(place), label, np.int32), place.view(np.int64), [c.tobytes() for c in chars]]
            types = (pa.int32(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["label", "place", "chars"])

    def first(place: np.ndarray, chars: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        added = _places(more)
        if len(place) >= sample:
            near = added <= place[-1]
            added, more = added[near], more[near]
        place, at = np.unique(np.concatenate([place, added]), return_index=True)
        return place[:sample], np.concatenate([chars, more])[at[:sample]]

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(over, "label int, place long, chars binary")
    found = stored(found, "findings")
    # As in the tasks, places are in order as unsigned numbers.
    order = [F.col("place").bitwiseXOR(F.lit(-(1 << 63)).cast("long")), "chars"]
    rows = {
        label: found.where(F.col("label") == label).distinct().orderBy(*order).limit(sample).select("chars").toArrow()["chars"].to_pylist()
        for label in (0, 1, 2)
    }
    arrays = [
        np.array([np.frombuffer(chars, np.uint8) for chars in own], np.uint8).reshape(-1, WINDOW)
        for own in (rows[1], rows[0] + rows[2])
    ]
    return fit(*arrays)


def scan(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans), one row per document: spans as (kind, start, end, score), by start and then by kind.

    Base findings have score 1. The candidates of many texts go through the network together.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans: list[list[tuple[int, int, int, float]]] = []
            held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            n = 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = base_spans(text or "")
                spans.append([(*span, 1.0) for span in found])
                runs = other_runs(text or "", found)
                if len(runs):
                    held.append((i, runs, *windows(text or "", runs)))
                    n += len(held[-1][2])
                if n >= SCORED:
                    judge(spans, held)
                    held, n = [], 0
            judge(spans, held)
            rows = [
                [{"kind": KINDS[kind], "start": start, "end": end, "score": score} for start, end, kind, score in sorted(own, key=lambda s: (s[0], s[2]))]
                for own in spans
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, shape)], [id_col, "spans"])

    def judge(spans: list[list], held: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Add the candidates that reach the threshold in any of their windows."""
        if not held:
            return
        scores = sent.value.score(np.concatenate([h[3] for h in held]))
        at = 0
        for i, runs, row, chars in held:
            own = scores[at : at + len(chars)]
            at += len(chars)
            if own.max() >= sent.value.threshold:
                best = np.zeros(len(runs))
                np.maximum.at(best, row, own)
                for k in np.flatnonzero(best >= sent.value.threshold):
                    spans[i].append((int(runs[k, 0]), int(runs[k, 1]), 3, float(best[k])))

    fields = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]
    shape = pa.list_(pa.struct(fields))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(over, f"`{id_col}` {kind}, spans array<struct<kind:string,start:int,end:int,score:double>>")
