"""Quality by supervised subword embeddings.

Each word and each character n-gram inside a word has a learned vector in a hashed table; a text is the mean of its
vectors, and a softmax layer over that mean gives the class.  Trained here by numpy stochastic gradient descent on a
bounded sample of the labelled rows.  A word that repeats the one before it counts as one common n-gram.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame

from tallyloom.llm.frames import map_columns
from tallyloom.llm.samples import gram_features, labelled
from tallyloom.llm.words import Grams

GRAMS = Grams(orders=(2, 3, 4), bits=16, words=True, fold=False)
SAMPLE_ROWS = 4_000
DIMENSION, ROUNDS, RATE = 10, 12, 0.5


@dataclass(frozen=True)
class QualityModel:
    """The embedding table, the softmax layer's weights and its constants."""

    vectors: np.ndarray
    layer: np.ndarray
    constants: np.ndarray

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Chance of class 1.  The layer is linear in the mean, so each vector goes through it before the mean is taken:
        the same number, with one value to look up per n-gram instead of a vector."""
        through = (self.vectors @ (self.layer[:, 1] - self.layer[:, 0])).reshape(-1, 1).astype(np.float32)
        total, count = GRAMS.sums(texts, through)
        margin = total[:, 0] / np.maximum(count, 1) + self.constants[1] - self.constants[0]
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, rounds: int = ROUNDS) -> QualityModel:
    """Stochastic gradient descent over (buckets, counts) and 0/1 labels, one text a step, with a falling rate."""
    random = np.random.default_rng(5)
    vectors = random.uniform(-1 / DIMENSION, 1 / DIMENSION, (GRAMS.size, DIMENSION)).astype(np.float32)
    layer, constants = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    shares = [(c / max(1, c.sum())).astype(np.float32) for _, c in rows]
    done, steps = 0, max(1, rounds * len(rows))
    for _ in range(rounds):
        for i in random.permutation(len(rows)):
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            buckets, share = rows[i][0], shares[i]
            mean = share @ vectors[buckets]
            out = mean @ layer + constants
            chance = np.exp(out - out.max())
            slope = chance / chance.sum()
            slope[int(y[i])] -= 1
            back = layer @ slope
            layer -= rate * np.outer(mean, slope)
            constants -= rate * np.float32(0.1) * slope
            # Scaled up: each n-gram's share of a text is small, and its vector would hardly move.
            vectors[buckets] -= (rate * np.float32(50) * share)[:, None] * back
    return QualityModel(vectors, layer, constants)


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "quality", text: str = "text",
        id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Learn from labelled rows where `train_on` holds; about `sample_rows` of them.

    Null texts, ids or labels teach nothing; without rows every text scores 0.5.
    """
    rows = labelled(docs, labels, train_on, label, text, id_column, sample_rows)
    features, y = gram_features(rows, GRAMS)
    return train(features, np.array(y))


def score(df: DataFrame, model: QualityModel, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `score` (0 to 1) and `predicted` (1 from 0.5 on) of the whole text.  Null and empty texts get the score of a
    text without n-grams; rows are independent; kept columns of these names give way."""

    def compute(texts):
        chance = model.scores(texts)
        return chance.tolist(), (chance >= 0.5).astype(int).tolist()

    return map_columns(df, "score double, predicted int", compute, [text], keep)


__all__ = ("QualityModel", "fit", "score", "train")
