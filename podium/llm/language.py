"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the bag of the byte n-grams (2 to 4) of its words, with word edges marked and ASCII letters
lower-cased; digits and ASCII punctuation separate words. Each n-gram is hashed to a row of an embedding
table; the rows are averaged and a softmax over the languages reads the average. Table and softmax are
trained by stochastic gradient descent in numpy on at most about ``sample`` labelled texts (a hash of the
text picks them, whole texts are used). A held-back fifth of them sets the temperature of the scores and
the score below which a text is rejected.

A softmax must choose one of its languages and can be sure of a text in none of them. A text is therefore also
rejected if its n-grams are too rare in the language that it is given: the mean log share of its n-grams among
those of the learned texts is set against the usual mean, in units of the deviation that texts of its length show.
Usual mean, deviations and cut come from the learned texts, each judged by the n-grams of all the others. Both cuts
together keep the share ``keep_share`` of the texts rightly recognised. A text of a word or two deviates so much by
chance that gibberish of that length often passes.

Prediction multiplies table and softmax once (a few numbers per n-gram) and sums them over whole texts, in
numpy, many texts at a time; nothing is shuffled.

Results by case: null texts and texts without a letter are ``und`` with score 0 and are rejected; rows
without a label are not learned from; ties go to the language first in order; repeated rows are learned from
and predicted each; without any labelled text the prediction is ``und`` with score 0 and only texts without
a letter are rejected; an empty table gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podium.llm.words import pieces

UNKNOWN = "und"
#: Labelled texts that the fit sees at most, about; they are collected as bucket counts of a few KB each.
SAMPLE = 4_000
BUCKET_BITS = 15
DIMENSIONS = 16
SIZES = (2, 3, 4)


def _letters() -> np.ndarray:
    """The lower-cased byte of a letter (or of any other character than ASCII), else 0."""
    table = np.zeros(256, np.uint8)
    table[0x61:0x7B] = np.arange(0x61, 0x7B)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    return table


_LETTERS = _letters()


def subwords(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, bucket) of the n-grams of each size; a text starts and ends with a word edge."""
    code = np.zeros(len(data) + len(offsets) + 3, np.uint32)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    code[np.arange(len(data)) + np.repeat(np.arange(1, len(offsets)), np.diff(offsets))] = _LETTERS[data]
    n = len(text)
    for size in SIZES:
        gram = np.zeros(n, np.uint32)
        for k in range(size):
            gram |= code[k : k + n] << np.uint32(8 * k)
        inner = np.ones(n, bool)
        for k in range(1, max(size - 1, 2)):
            inner &= code[k : k + n] != 0
        at = np.flatnonzero(inner)
        mixed = (gram[at].astype(np.uint64) + np.uint64(size << 40)) * np.uint64(0x9E3779B97F4A7C15)
        yield text[at], (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letter = np.zeros(len(data) + 1, np.int64)
    np.cumsum((_LETTERS[data] > 0) & (data < 0x80), out=ascii_letter[1:])
    found = ascii_letter[offsets[1:]] > ascii_letter[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(c.isalpha() for c in data[offsets[i] : offsets[i + 1]].tobytes().decode())
    return found


@dataclass(frozen=True)
class LanguageModel:
    """``weights``: bucket × language, the embedding table times the softmax matrix.

    ``shares``: bucket × language, the log share of an n-gram among those of the language, against an even share.
    ``usual`` is its usual mean over a text, ``spread`` its variance (constant, and per inverse number of n-grams),
    ``least`` the deviation below which a text is rejected.
    """

    languages: tuple[str, ...]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    shares: np.ndarray
    usual: float = 0.0
    spread: tuple[float, float] = (1.0, 0.0)
    least: float = -np.inf

    def logits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, mean log shares in each language, and numbers of n-grams."""
        texts, languages = len(offsets) - 1, len(self.languages)
        both = np.concatenate([self.weights, self.shares], 1)
        total, count = np.zeros((texts, 2 * languages)), np.zeros(texts)
        for text, bucket in subwords(data, offsets):
            own = np.bincount(text, minlength=texts)
            first = np.cumsum(own) - own
            full = own > 0
            if full.any():
                total[full] += np.add.reduceat(both[bucket], first[full], axis=0, dtype=np.float64)
            count += own
        total /= np.maximum(count, 1)[:, None]
        return total[:, :languages] + self.bias, total[:, languages:], count

    def deviation(self, share: np.ndarray, count: np.ndarray) -> np.ndarray:
        """How far mean log shares of texts of so many n-grams lie from the usual mean."""
        return (share - self.usual) / np.sqrt(self.spread[0] + self.spread[1] / np.maximum(count, 1))

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, accepted) of each text."""
        letter = _has_letter(data, offsets)
        if not self.languages:
            return [UNKNOWN] * len(letter), np.zeros(len(letter)), letter
        logits, shares, count = self.logits(data, offsets)
        chances = _softmax(logits / self.temperature)
        best = chances.argmax(1)
        score = np.where(letter, chances[np.arange(len(best)), best], 0.0)
        known = self.deviation(shares[np.arange(len(best)), best], count) >= self.least
        names = [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, letter, strict=True)]
        return names, score, letter & (score >= self.threshold) & known


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(-1, keepdims=True))
    return x / x.sum(-1, keepdims=True)


def fit(bags: list[tuple[str, np.ndarray, np.ndarray]], keep_share: float = 0.999, epochs: int = 8, seed: int = 7) -> LanguageModel:
    """Train on (label, buckets, counts) of labelled texts."""
    bags = [bag for bag in bags if len(bag[1])]
    languages = tuple(sorted({label for label, _, _ in bags}))
    if not languages:
        none = np.zeros((1 << BUCKET_BITS, 0), np.float32)
        return LanguageModel((), none, np.zeros(0), 1.0, 0.0, none)
    random = np.random.default_rng(seed)
    order = random.permutation(len(bags))
    held = order[: len(bags) // 5]
    learn = order[len(held) :]
    target = np.array([languages.index(label) for label, _, _ in bags])
    table = random.uniform(-1, 1, (1 << BUCKET_BITS, DIMENSIONS)) / DIMENSIONS
    soft, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = epochs * len(learn), 0
    for _ in range(epochs):
        for i in random.permutation(learn):
            rate = 1.0 * (1 - step / steps)
            step += 1
            _, buckets, counts = bags[i]
            share = counts / counts.sum()
            mean = share @ table[buckets]
            error = _softmax(mean @ soft + bias)
            error[target[i]] -= 1
            back = soft @ error
            soft -= rate * np.outer(mean, error)
            bias -= 0.1 * rate * error
            table[buckets] -= rate * 20 * share[:, None] * back
    judged = held if len(held) else learn
    logits = np.array([(bags[i][2] / bags[i][2].sum()) @ table[bags[i][1]] @ soft + bias for i in judged])

    def loss(temperature: float) -> float:
        chances = _softmax(logits / temperature)
        return float(-np.log(chances[np.arange(len(judged)), target[judged]] + 1e-12).mean())

    temperature = min((0.1 * 1.25**k for k in range(30)), key=loss)
    chances = _softmax(logits / temperature)
    right = chances.argmax(1) == target[judged]
    # Two cuts, so each may lose half of what may be lost.
    lost = (1 - keep_share) / 2
    scores = np.sort(chances.max(1)[right])
    cut = float(scores[int(lost * len(scores))]) if len(scores) else 0.0
    shares, found, sizes = _shares(bags, languages)
    usual = float(np.median(found))
    spread = _spread(found - usual, sizes)
    model = LanguageModel(languages, (table @ soft).astype(np.float32), bias, temperature, cut, shares, usual, spread)
    deviations = np.sort(model.deviation(found, sizes))
    return replace(model, least=float(deviations[int(lost * len(deviations))]))


def _shares(
    bags: list[tuple[str, np.ndarray, np.ndarray]], languages: tuple[str, ...]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log shares of the n-grams in each language, then mean log share and size of each text, judged by the others.

    Equal texts count once, so that none is judged by its own copies.
    """
    bags = list({(label, keys.tobytes(), counts.tobytes()): (label, keys, counts) for label, keys, counts in bags}.values())
    buckets = 1 << BUCKET_BITS
    total = np.zeros((buckets, len(languages)))
    for label, keys, counts in bags:
        total[keys, languages.index(label)] += counts
    sums = total.sum(0)

    def log_share(times: np.ndarray, of: np.ndarray | float) -> np.ndarray:
        return np.log((times + 0.5) / (of + 0.5 * buckets) * buckets)

    found, sizes = np.zeros(len(bags)), np.zeros(len(bags))
    for i, (label, keys, counts) in enumerate(bags):
        k, sizes[i] = languages.index(label), counts.sum()
        found[i] = counts @ log_share(total[keys, k] - counts, sums[k] - sizes[i]) / sizes[i]
    return log_share(total, sums).astype(np.float32), found, sizes


def _spread(off: np.ndarray, sizes: np.ndarray) -> tuple[float, float]:
    """Variance of the mean log share: a constant, and a part that falls with the number of n-grams."""
    x = np.stack([np.ones(len(sizes)), 1 / sizes], 1)
    constant, part = np.linalg.lstsq(x, off**2, rcond=None)[0]
    return max(float(constant), 1e-3), max(float(part), 0.0)


def train(
    docs: DataFrame, learn: Column, text_col: str = "text", label_col: str = "lang", sample: int = SAMPLE
) -> LanguageModel:
    """Fit on the rows where ``learn`` holds and text and label are given."""
    rows = docs.where(learn & F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.select(F.col(label_col).cast("string"), F.col(text_col).cast("string"))
    total = rows.count()
    part = min(1.0, sample / total) if total else 1.0
    picked = F.pmod(F.xxhash64(text_col, F.lit("sample")), F.lit(1_000_000)) < int(part * 1_000_000) + 1

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, counts = [], []
            for _, data, offsets in pieces(batch.column(1)):
                found = list(subwords(data, offsets))
                text = np.concatenate([f[0] for f in found])
                keys, times = np.unique(text << BUCKET_BITS | np.concatenate([f[1] for f in found]), return_counts=True)
                cuts = np.searchsorted(keys, np.arange(1, len(offsets) - 1) << BUCKET_BITS)
                buckets += np.split((keys & (1 << BUCKET_BITS) - 1).astype(np.int32), cuts)
                counts += np.split(times.astype(np.int32), cuts)
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(buckets, lists), pa.array(counts, lists)], names)

    names = ["label", "buckets", "counts"]
    found = rows.where(picked).mapInArrow(over, "label string, buckets array<int>, counts array<int>").toArrow()
    bags = [
        (label, np.asarray(buckets.values), np.asarray(counts.values))
        for label, buckets, counts in zip(found["label"].to_pylist(), found["buckets"], found["counts"], strict=True)
    ]
    # Whatever order the tasks ended in, the fit sees the same order.
    bags.sort(key=lambda bag: (bag[0], len(bag[1]), bag[1].tobytes(), bag[2].tobytes()))
    return fit(bags)


def predict(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted), one row per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores, accepted = [], [], []
            for _, data, offsets in pieces(batch.column(1), 1 << 19):
                found = sent.value.predict(data, offsets)
                names += found[0]
                scores += found[1].tolist()
                accepted += found[2].tolist()
            columns = [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "lang_pred", "score", "accepted"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, F.col(text_col).cast("string"))
    return rows.mapInArrow(over, f"`{id_col}` {kind}, lang_pred string, score double, accepted boolean")


def drop_rejected(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that the model accepts, with all their columns; no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                ok
                for _, data, offsets in pieces(batch.column(text_col), 1 << 19)
                for ok in sent.value.predict(data, offsets)[2].tolist()
            ]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(over, docs.schema)
