"""Text quality: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pair sum
is taken in linear time as half the sum over factors of (sum v x)**2 - sum (v x)**2.
Words enter as hashed log counts of unit length, statistics of structure (case,
punctuation, symbols, repetition, word and line lengths) and the length in
characters (the only metadata used) as indicators of quantile bins, so that
pairs can express, say, a short text with much repetition.

Defined cases: a null text is empty; an empty text scores by its statistics.
Without usable labels every score is 0.5.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark.sql import DataFrame

from .common import word_bounds, word_hashes
from .features import labelled_sample, learn, score_documents, sigmoid

BITS = 14
FACTORS = 6
BINS = 12
SAMPLE = 6000
EPOCHS = 6
RATE, DECAY = 0.1, 1e-4
THRESHOLD = 0.3
_WORDS = 1 << BITS
_UPPER, _LOWER, _DIGIT, _SPACE, _WIDE, _STOP, _MARK = range(7)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = _UPPER, _LOWER, _DIGIT, _WIDE
_CLASS[[32, *range(9, 14)]] = _SPACE
_CLASS[list(b".,")] = _STOP


def statistics(text: bytes, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length, shares of character classes, repetition and line measures."""
    n, n_words = len(text), len(words)
    data = np.frombuffer(text, np.uint8)
    n_chars = n - int(np.count_nonzero((data & 0xC0) == 0x80))
    share = np.bincount(_CLASS[data], minlength=7) / max(n, 1)
    starts, ends = word_bounds(text)
    lengths = ends - starts if n_words else np.zeros(1)
    lines = text.count(b"\n") + 1
    last = _CLASS[data[ends - 1]] if n_words else np.zeros(1, np.uint8)
    stays = np.count_nonzero(words[1:] == words[:-1]) / max(n_words - 1, 1)
    p = counts / max(n_words, 1)
    return np.array(
        [
            np.log1p(n_chars), *share, share[_UPPER] / max(share[_UPPER] + share[_LOWER], 1e-9),
            len(counts) / max(n_words, 1), counts.max() / n_words if n_words else 0.0, stays,
            -float((p * np.log(p)).sum()) if n_words else 0.0, lengths.mean(), lengths.std(), lengths.max(),
            np.mean(last == _MARK), np.mean(last == _STOP), np.mean(lengths == 1), n_words / lines, lines / max(n_words, 1),
        ]
    )


N_STATISTICS = 21


def features(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers, their values, and the statistics."""
    words = word_hashes(text.lower())
    distinct, counts = np.unique(words, return_counts=True)
    numbers, at = np.unique((distinct >> np.uint64(64 - BITS)).astype(np.int64), return_inverse=True)
    values = np.log1p(np.bincount(at, weights=counts, minlength=len(numbers)))
    norm = np.sqrt((values * values).sum())
    return numbers, values / norm if norm else values, statistics(text, words, counts)


def _packed(text: bytes) -> bytes:
    numbers, values, stats = features(text)
    return stats.astype(np.float64).tobytes() + numbers.astype(np.int32).tobytes() + values.astype(np.float32).tobytes()


def _unpacked(row: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    stats, rest = np.frombuffer(row[: 8 * N_STATISTICS]), row[8 * N_STATISTICS :]
    half = len(rest) // 2
    return np.frombuffer(rest[:half], np.int32).astype(np.int64), np.frombuffer(rest[half:], np.float32).astype(float), stats


class Model:
    """Bin edges of the statistics, bias, linear weights and factors."""

    def __init__(self, edges: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.edges, self.bias, self.linear, self.factors = edges, bias, linear, factors

    def inputs(self, numbers: np.ndarray, values: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bins = (stats[:, None] > self.edges).sum(axis=1)
        binned = _WORDS + np.arange(N_STATISTICS) * BINS + bins
        return np.concatenate([numbers, binned]), np.concatenate([values, np.ones(N_STATISTICS)])

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        vx = self.factors[at] * x[:, None]
        total = vx.sum(axis=0)
        pairs = 0.5 * float((total * total).sum() - (vx * vx).sum())
        return self.bias + float(self.linear[at] @ x) + pairs, vx, total

    def score(self, text: bytes) -> float:
        return sigmoid(self.raw(*self.inputs(*features(text)))[0])


def fit(labels: list[int], rows: list[bytes]) -> bytes:
    """Adaptive-rate gradient descent on the log loss."""
    examples = [_unpacked(r) for r in rows]
    size = _WORDS + N_STATISTICS * BINS
    rng = np.random.Generator(np.random.PCG64(7))
    steps = np.arange(1, BINS) / BINS
    stats = np.array([e[2] for e in examples]).reshape(-1, N_STATISTICS)
    edges = np.quantile(stats, steps, axis=0).T if len(stats) else np.zeros((N_STATISTICS, BINS - 1))
    model = Model(edges, 0.0, np.zeros(size), 0.02 * rng.standard_normal((size, FACTORS)))
    seen_w, seen_v, seen_b = np.full(size, 1e-2), np.full((size, FACTORS), 1e-2), 1e-2
    inputs = [model.inputs(*e) for e in examples]
    for _ in range(EPOCHS):
        for i in rng.permutation(len(inputs)):
            at, x = inputs[i]
            out, vx, total = model.raw(at, x)
            g = sigmoid(out) - labels[i]
            g_w = g * x + DECAY * model.linear[at]
            g_v = g * (x[:, None] * (total - vx)) + DECAY * model.factors[at]
            seen_b += g * g
            seen_w[at] += g_w * g_w
            seen_v[at] += g_v * g_v
            model.bias -= RATE * g / np.sqrt(seen_b)
            model.linear[at] -= RATE * g_w / np.sqrt(seen_w[at])
            model.factors[at] -= 0.5 * RATE * g_v / np.sqrt(seen_v[at])
    model.linear = model.linear.astype(np.float32)
    model.factors = model.factors.astype(np.float32) if len(rows) else np.zeros((size, FACTORS), np.float32)
    return pickle.dumps(model)


def train(docs: DataFrame, labels: DataFrame, keep: str = "true", label: str = "quality", sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents for which ``keep``,
    SQL with ``{id}`` for the id, holds."""
    return pickle.loads(learn(labelled_sample(docs, labels, label, keep, sample, _packed), fit))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, score) of every row."""
    return score_documents(docs, model.score)
