"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A document's features are the distinct hashes of its lower-cased words, of the
words cut to a stem of 4 and 5 bytes (abuse is often inflected), of pairs of
neighbours and of pairs with one word between, all present or absent. FTRL-
proximal gives each coordinate its own learning rate, and its L1 term leaves
most weights at exactly zero, so the model is a short list of (feature, weight)
that is broadcast whatever the corpus size (at most 2**BITS entries).

Defined cases: a null text is empty; a text without words scores by the bias
alone. Labels of unknown documents and null labels are ignored; if no usable
label is left every score is 0.5.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .common import mix64, prefix_hashes
from .features import labelled_sample, learn, score_documents, sigmoid

BITS = 20
SAMPLE = 6000
EPOCHS = 10
STEMS = (4, 5)
# L1 of one per epoch: a feature of a single document can never get a weight.
ALPHA, BETA, L1, L2 = 0.5, 1.0, float(EPOCHS), 0.01
THRESHOLD = 0.7
_KINDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25, 0xC2B2AE3D27D4EB4F)


def features(text: bytes) -> np.ndarray:
    """Sorted distinct feature numbers; 0 is the bias."""
    words, *stems = prefix_hashes(text.lower(), [None, *STEMS])
    word, pair, skip = (np.uint64(k) for k in _KINDS)
    parts = [
        *(mix64(s + np.uint64(n)) for s, n in zip(stems, STEMS, strict=True)),
        mix64(words ^ word),
        mix64(words[:-1] * pair + words[1:]),
        mix64(words[:-2] * skip + words[2:]),
    ]
    numbers = np.concatenate(parts) >> np.uint64(64 - BITS)
    return np.unique(np.concatenate([np.zeros(1, np.int64), numbers.astype(np.int64)])).astype(np.int32)


def _packed(text: bytes) -> bytes:
    return features(text).tobytes()


def fit(labels: list[int], rows: list[bytes]) -> bytes:
    """Non-zero weights as (numbers, weights), packed."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(at: np.ndarray) -> np.ndarray:
        excess = np.abs(z[at]) - L1
        rate = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(excess > 0, -np.sign(z[at]) * excess / rate, 0.0)

    examples = [np.frombuffer(r, np.int32) for r in rows]
    if examples:
        # L1 keeps features of a single document at zero, so they can be left out.
        often = np.bincount(np.concatenate(examples), minlength=1 << BITS) > 1
        examples = [e[often[e]] for e in examples]
    rng = np.random.Generator(np.random.PCG64(5))
    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at = examples[i]
            w = weights(at)
            g = sigmoid(w.sum()) - labels[i]
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(1 << BITS))
    kept = np.flatnonzero(w).astype(np.int32)
    return kept.tobytes() + w[kept].astype(np.float32).tobytes()


class Model:
    """Compact weights; the dense table is rebuilt once per worker process."""

    def __init__(self, packed: bytes):
        self.packed = packed
        self.dense: np.ndarray | None = None

    def __getstate__(self) -> bytes:
        return self.packed

    def __setstate__(self, packed: bytes) -> None:
        self.packed, self.dense = packed, None

    def score(self, text: bytes) -> float:
        if self.dense is None:
            count = len(self.packed) // 8
            self.dense = np.zeros(1 << BITS, np.float32)
            self.dense[np.frombuffer(self.packed[: 4 * count], np.int32)] = np.frombuffer(self.packed[4 * count :], np.float32)
        return sigmoid(float(self.dense[features(text)].sum(dtype=np.float64)))


def train(docs: DataFrame, labels: DataFrame, keep: str = "true", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled documents for which ``keep``,
    SQL with ``{id}`` for the id, holds."""
    return Model(learn(labelled_sample(docs, labels, label, keep, sample, _packed), fit))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(id, score) of every row."""
    return score_documents(docs, model.score)
