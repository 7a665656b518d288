"""Quality classifier: naive Bayes features under a linear support vector machine.

A text is the set of its n-grams: byte 1- to 4-grams as they stand (case and punctuation tell much about
quality) and pairs of neighbouring words, with marks of their own for runs of one word; all are hashed to
buckets. Each bucket is scaled by its log-count ratio, the logarithm of how much more frequent it is
among texts of label 1 than of label 0, and the vector is brought to unit length. On it a hinge-loss model
is fitted by dual coordinate descent. A held-back fifth of the fitted sample turns margins into
probabilities (a logistic curve).

The counts behind the ratios cover every labelled training text: tasks add them up and Spark sums them by
bucket. Only the descent sees a sample of at most about ``sample`` texts, picked by a hash of the text. Scoring
is two table look-ups per n-gram, in numpy over whole texts, without a shuffle.

Results by case: null and empty texts have no n-grams and get the score that the intercept gives; rows
whose label is null or whose text is null are not learned from; repeated rows are learned from and scored
each; with one class or no labelled text at all every score is the share of label 1 (0.5 without any);
ties at 0.5 are predicted 1; an empty table gives an empty table; other columns, whatever their names,
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from podium.llm.words import mix, pieces, words_of
from podium.llm.work import inner_join, stored

#: Labelled texts that the descent sees at most, about; each is collected as at most 4 bytes per bucket.
SAMPLE = 6_000
BUCKET_BITS = 17
BUCKETS = 1 << BUCKET_BITS
GRAMS = (1, 2, 3, 4)
#: Lengths of runs of one word that have a mark of their own, whatever the word.
REPEATS = (2, 3, 4, 6, 8)


def _slot(x: np.ndarray, kind: int) -> np.ndarray:
    mixed = (x + np.uint64(kind << 48)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted buckets of each text."""
    words = words_of(data, offsets)
    codes = data.astype(np.uint64)
    grams = []
    gram = np.zeros(len(data), np.uint64)
    for size in range(1, max(GRAMS) + 1):
        gram = gram[: len(data) - size + 1] | (codes[size - 1 :] << np.uint64(8 * (size - 1))) if len(data) >= size else gram[:0]
        if size in GRAMS:
            grams.append((size, _slot(gram, size)))
    pairs = _slot(mix(words.hash[:-1] * np.uint64(3) + words.hash[1:]), 9)
    same = words.hash[1:] == words.hash[:-1]
    repeats = []
    for size in REPEATS:
        n = max(0, len(words.hash) - size + 1)
        run = np.ones(n, bool)
        for k in range(size - 1):
            run &= same[k : k + n]
        repeats.append((size, np.flatnonzero(run), int(_slot(np.array([size], np.uint64), 10)[0])))
    seen = np.zeros(BUCKETS, bool)
    for i in range(len(offsets) - 1):
        lo, hi = int(offsets[i]), int(offsets[i + 1])
        for size, slots in grams:
            seen[slots[lo : max(lo, hi - size + 1)]] = True
        first = int(words.first[i])
        last = first + int(words.count[i])
        seen[pairs[first : max(first, last - 1)]] = True
        for size, runs, slot in repeats:
            if np.searchsorted(runs, first) < np.searchsorted(runs, last - size + 1):
                seen[slot] = True
        found = np.flatnonzero(seen)
        seen[found] = False
        yield found


def log_count_ratios(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Logarithm of the smoothed share of each bucket among label 1 over that among label 0."""
    p, q = positive + 1.0, negative + 1.0
    return np.log((p / p.sum()) / (q / q.sum()))


@dataclass(frozen=True)
class QualityModel:
    """Per bucket the scaled weight and the squared ratio; then the logistic curve."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        length = np.sqrt(self.squares[found].sum(dtype=np.float64))
        return float(self.weights[found].sum(dtype=np.float64) / length + self.bias) if length else self.bias

    def score(self, data: np.ndarray, offsets: np.ndarray) -> list[float]:
        margins = np.array([self.margin(found) for found in features(data, offsets)])
        return (1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))).tolist()


def _constant(share: float) -> QualityModel:
    share = min(max(share, 1e-6), 1 - 1e-6)
    empty = np.zeros(BUCKETS, np.float32)
    return QualityModel(empty, empty, 0.0, 0.0, float(np.log(share / (1 - share))))


def descend(rows: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, cost: float, epochs: int, seed: int) -> np.ndarray:
    """Weights (the last is the intercept's) that minimise |w|²/2 + cost·Σ hinge, one dual variable at a time."""
    random = np.random.default_rng(seed)
    weights = np.zeros(BUCKETS + 1)
    dual = np.zeros(len(rows))
    norms = np.array([(v * v).sum() + 1 for v in values])
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            slope = labels[i] * (values[i] @ weights[rows[i]] + weights[-1]) - 1
            new = min(max(dual[i] - slope / norms[i], 0.0), cost)
            if new != dual[i]:
                change = (new - dual[i]) * labels[i]
                weights[rows[i]] += change * values[i]
                weights[-1] += change
                dual[i] = new
    return weights


def _curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve with the smallest log loss, by Newton's method."""
    n_pos, n_neg = (labels > 0).sum(), (labels < 0).sum()
    goal = np.where(labels > 0, (n_pos + 1) / (n_pos + 2), 1 / (n_neg + 2))
    x = np.stack([margins, np.ones(len(margins))], 1)
    at = np.zeros(2)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        curvature = x.T @ (x * (chance * (1 - chance))[:, None]) + 1e-4 * np.eye(2)
        at = at - np.linalg.solve(curvature, x.T @ (chance - goal) + 1e-4 * at)
    return float(at[0]), float(at[1])


def fit(
    rows: list[tuple[int, np.ndarray]], positive: np.ndarray, negative: np.ndarray, cost: float = 3.0, epochs: int = 12, seed: int = 5
) -> QualityModel:
    """Train on (label, buckets) of the sample and on the counts of all labelled texts."""
    labels = np.array([1.0 if label == 1 else -1.0 for label, _ in rows])
    if not len(rows) or abs(labels.sum()) == len(rows):
        return _constant(0.5 if not len(rows) else float((labels > 0).mean()))
    ratios = log_count_ratios(positive, negative)
    found = [r for _, r in rows]
    values = [ratios[r] / max(np.sqrt((ratios[r] ** 2).sum()), 1e-12) for r in found]
    order = np.random.default_rng(seed).permutation(len(rows))
    held, learn = order[: len(rows) // 5], order[len(rows) // 5 :]

    def weights(own: np.ndarray) -> np.ndarray:
        return descend([found[i] for i in own], [values[i] for i in own], labels[own], cost, epochs, seed)

    judged, judge = (held, weights(learn)) if len(set(labels[held])) == 2 else (order, weights(order))
    slope, shift = _curve(np.array([values[i] @ judge[found[i]] + judge[-1] for i in judged]), labels[judged])
    final = weights(order)
    return QualityModel((final[:-1] * ratios).astype(np.float32), (ratios**2).astype(np.float32), float(final[-1]), slope, shift)


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE
) -> QualityModel:
    """Fit on the documents that ``labels`` (id, label 0 or 1) marks."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    marks = marks.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label"))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("__id"), F.col(text_col).cast("string").alias("__text"))
    total = marks.count()
    part = min(1.0, sample / total) if total else 1.0
    picked = F.pmod(F.xxhash64("__text", F.lit("sample")), F.lit(1_000_000)) < int(part * 1_000_000) + 1
    rows = inner_join(texts, marks, ["__id"]).select("__label", "__text", picked.alias("__picked"))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            label, picked_ = batch.column(0).to_numpy(), batch.column(2).to_pylist()
            kept: list[tuple[int, np.ndarray]] = []
            at = 0
            for _, data, offsets in pieces(batch.column(1)):
                for found in features(data, offsets):
                    counts[label[at], found] += 1
                    if picked_[at]:
                        kept.append((int(label[at]), found.astype("<i4").tobytes()))
                    at += 1
            yield rows_of(None, None, None, kept)
        used = np.flatnonzero(counts.any(0))
        yield rows_of(used.astype(np.int32), counts[1, used], counts[0, used], [])

    def rows_of(bucket, positive, negative, kept) -> pa.RecordBatch:
        n = 0 if bucket is None else len(bucket)
        nulls = [None] * len(kept)
        columns = [
            pa.array(nulls if bucket is None else bucket, pa.int32()),
            pa.array(nulls if bucket is None else positive, pa.int64()),
            pa.array(nulls if bucket is None else negative, pa.int64()),
            pa.array([k[0] for k in kept] or [None] * n, pa.int32()),
            pa.array([k[1] for k in kept] or [None] * n, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "positive", "negative", "label", "found"])

    made = stored(rows.mapInArrow(over, "bucket int, positive long, negative long, label int, found binary"), "quality")
    sums = made.where("bucket is not null").groupBy("bucket").agg(F.sum("positive").alias("p"), F.sum("negative").alias("q")).toArrow()
    counts = np.zeros((2, BUCKETS))
    counts[0, sums["bucket"].to_numpy()] = sums["p"].to_numpy()
    counts[1, sums["bucket"].to_numpy()] = sums["q"].to_numpy()
    kept = made.where("label is not null").select("label", "found").toArrow()
    # Whatever order the tasks ended in, the fit sees the same order.
    sampled = sorted(zip(kept["label"].to_pylist(), kept["found"].to_pylist(), strict=True))
    return fit([(label, np.frombuffer(found, "<i4").astype(np.int64)) for label, found in sampled], counts[0], counts[1])


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted), one row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [s for _, data, offsets in pieces(batch.column(1), 1 << 20) for s in sent.value.score(data, offsets)]
            columns = [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(over, f"`{id_col}` {kind}, score double, predicted int")
