"""Quality by logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Words are runs of letters and digits and runs of other signs; a word that repeats one of the two before it counts as a
mark of repetition. A feature's value is its share of the text's words and word pairs, so a score is a sparse dot product
that does not depend on a text's length. Training reads a bounded sample of labelled rows.

Null and empty texts get the score of a text without words; texts are scored whole; repeated rows get equal scores; an
empty table gives an empty result; without labelled rows of both classes every score is 1; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from disclosa.llm.hashed import coder, held_out, scored, trained, training_rows

BITS = 18
#: The bounded sample: rows of either class, and words of a row, at most.
PER_CLASS, LONGEST = 3000, 12000
MODULUS, HELD = 4, 2
#: FTRL-proximal parameters, and what a share is multiplied with.
ALPHA, BETA, L1, L2, SCALE = 0.5, 1.0, 0.002, 0.01, 8.0
LEAST = 0.7
REPEATED = 0x5DEECE66D

words = coder(r"\w+|[^\w\s]+", lower=False)


def features(codes: np.ndarray) -> np.ndarray:
    """The places of a text's words and word pairs."""
    h = codes.copy()
    for lag in (1, 2):
        h[lag:][codes[lag:] == codes[:-lag]] = REPEATED
    mask = (1 << BITS) - 1
    pairs = ((h[:-1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:].astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate([h & mask, (pairs >> np.uint64(40)).astype(np.int64) & mask])


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, codes: np.ndarray) -> float:
        f = features(codes)
        z = self.bias + (SCALE * self.weights[f].sum() / len(f) if len(f) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(texts: list[np.ndarray], y: np.ndarray, epochs: int = 4, seed: int = 5) -> Model:
    """FTRL-proximal, one row at a time; the classes count equally."""
    size = 1 << BITS
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(size), 30.0)
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    rows = []
    for t in texts:
        at, count = np.unique(features(t), return_counts=True)
        rows.append((np.append(at, size), np.append(SCALE * count / max(1, count.sum()), 1.0)))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zz = z[at]
        return np.where(np.abs(zz) <= L1, 0.0, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            at, x = rows[r]
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - y[r]) * share[r] * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA * w
            n[at] += g * g
    final = weights(slice(None))
    return Model(final[:size].astype(np.float32), float(final[size]))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    rows = training_rows(documents, labels, "quality", (MODULUS, HELD), PER_CLASS)
    return trained(rows, words, LONGEST, lambda texts, y, _: train(texts, y))


def score_table(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted (score >= LEAST) and held_out of every row."""
    shipped = documents.sparkSession.sparkContext.broadcast(model)  # the weights have a fixed size

    def score(texts: list[str | None]) -> np.ndarray:
        return np.array([shipped.value.score(words(t)) for t in texts], dtype=np.float64)

    found = scored(documents, "score", score, [])
    return found.withColumns({"predicted": (F.col("score") >= LEAST).cast("int"), "held_out": held_out(MODULUS, HELD)})
