"""Toxicity by a factorization machine over hashed terms.

score = sigmoid(w0 + sum of w over the text's terms + sum of <v_i, v_j> over pairs of its terms): pairs, such as an
insult beside a mention of a group, count beyond what each term says alone.  Terms are a text's distinct lower-case
words, hashed; those that tell nothing of the label in the sample, neither alone nor beside another term, have weight and
factors zero.  Trained here by numpy on a bounded sample of the labelled rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import map_columns
from tallyloom.llm.samples import labelled
from tallyloom.llm.words import word_hashes

BITS = 18
SAMPLE_ROWS = 8_000
#: Terms that may have weights (as many again for pairs), the least standard score and texts of a term for that, factors
#: of a term, and the least score of a pair.
TERMS, LEAST_SCORE, LEAST_TEXTS, FACTORS = 512, 5.0, 8, 4
LEAST_PAIR = 6.5


def _buckets(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct term buckets of each text, and the bounds of the texts."""
    hashes, bounds = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    pairs = np.unique((owner << BITS) + (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    ends = np.searchsorted(pairs, np.arange(len(texts) + 1) << BITS)
    return pairs & ((1 << BITS) - 1), ends


@dataclass(frozen=True)
class ToxicityModel:
    """Constant, and for each hash bucket a place in the tables of weights and factors (-1: none)."""

    constant: float
    place: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """Chance of toxicity of each whole text; that of no known term at all for null and empty texts."""
        hashes, bounds = word_hashes(texts)
        place = self.place[(hashes >> np.uint64(64 - BITS)).astype(np.int64)]
        known = place >= 0
        owner = np.repeat(np.arange(len(texts)), np.diff(bounds))[known]
        m = max(1, len(self.weights))
        pairs = np.unique(owner * m + place[known])
        owner, term = pairs // m, pairs % m
        linear = np.bincount(owner, self.weights[term], minlength=len(texts)) if len(term) else np.zeros(len(texts))
        both = np.zeros(len(texts))
        for f in range(self.factors.shape[1]) if len(term) else ():
            v = self.factors[term, f]
            both += np.bincount(owner, v, minlength=len(texts)) ** 2 - np.bincount(owner, v * v, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(self.constant + linear + both / 2, -40, 40)))


def _entropy(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    """n times the entropy (nats) of a label that `ones` of n texts have."""
    zeros = n - ones
    each = [x * np.log(np.maximum(n, 1) / np.maximum(x, 1)) for x in (ones, zeros)]
    return each[0] + each[1]


def _paired(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets of pairs whose texts differ in label from those of either term without the other.

    The score is the root of the likelihood ratio statistic, which holds for small counts too; LEAST_PAIR is beyond what
    chance gives among some 10**8 pairs.  Terms whose labels hold too little entropy for it are left out, all pairs of
    the others are counted, a term at a time: the work is the sum of the squares of the texts' terms.
    """
    seen, ones = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for row, label in zip(rows, y):
        seen[row] += 1
        ones[row] += int(label)
    terms = np.flatnonzero(2 * _entropy(ones, seen) >= LEAST_PAIR**2)
    m = len(terms)
    place = np.full(1 << BITS, -1)
    place[terms] = np.arange(m)
    own = [np.sort(place[row][place[row] >= 0]) for row in rows]
    text = np.repeat(np.arange(len(own)), [len(x) for x in own])
    term = np.concatenate([*own, np.empty(0, np.int64)]).astype(np.int64)
    order = np.argsort(term, kind="stable")
    bounds = np.searchsorted(term[order], np.arange(m + 1))
    text = text[order]
    seen, ones = seen[terms], ones[terms]

    def ratio(n, k, n_all, k_all):
        """Root of the likelihood ratio of the label's shares in n texts and in the others of n_all; 0 if either is small."""
        gain = _entropy(k_all, n_all) - _entropy(k, n) - _entropy(k_all - k, n_all - n)
        return np.where(n_all - n >= LEAST_TEXTS, np.sqrt(np.maximum(2 * gain, 0)), 0)

    best = np.zeros(m)
    for a in range(m):
        held = text[bounds[a] : bounds[a + 1]]
        toxic = y[held] == 1
        others = [np.concatenate([np.empty(0, np.int64), *[own[i] for i in part]]) for part in (held[toxic], held[~toxic])]
        k, clean = (np.bincount(x, minlength=m) for x in others)
        n = k + clean
        b = np.flatnonzero(n[a + 1 :] >= LEAST_TEXTS) + a + 1
        if len(b):
            found = np.minimum(ratio(n[b], k[b], seen[a], ones[a]), ratio(n[b], k[b], seen[b], ones[b]))
            best[a] = max(best[a], found.max())
            best[b] = np.maximum(best[b], found)
    order = np.argsort(-best, kind="stable")[:TERMS]
    return np.sort(terms[order[best[order] >= LEAST_PAIR]])


def _screened(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets whose share of texts differs most between the labels, by standard score."""
    seen = [np.zeros(1 << BITS), np.zeros(1 << BITS)]
    for row, label in zip(rows, y):
        seen[int(label)][row] += 1
    n = [max(1, int((y == k).sum())) for k in (0, 1)]
    share = (seen[0] + seen[1]) / (n[0] + n[1])
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n[0] + 1 / n[1]))
    score = np.abs(seen[1] / n[1] - seen[0] / n[0]) / spread
    score[(seen[0] + seen[1] < LEAST_TEXTS) | (score < LEAST_SCORE)] = 0
    best = np.argsort(-score, kind="stable")[:TERMS]
    return np.sort(best[score[best] > 0])


def train(rows: list[np.ndarray], y: np.ndarray, rounds: int = 400, penalty: tuple[float, float] = (2e-4, 3e-4)) -> ToxicityModel:
    """Fit by Adam on the logistic loss of all rows (sorted distinct buckets and 0/1 labels).

    `penalty` is on squared weights and on squared factors: dearer factors leave to pairs what terms alone can't say.
    """
    terms = np.union1d(_screened(rows, y), _paired(rows, y)) if len(rows) else np.empty(0, np.int64)
    place = np.full(1 << BITS, -1, np.int32)
    place[terms] = np.arange(len(terms))
    x = np.zeros((len(rows), len(terms)), np.float32)
    for line, row in zip(x, rows):
        at = place[row]
        line[at[at >= 0]] = 1
    random = np.random.default_rng(3)
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    w0 = np.array([np.log(rate / (1 - rate))])
    w, v = np.zeros(len(terms)), random.normal(0, 0.05, (len(terms), FACTORS))
    # The rarer label weighs more, by the root of its rarity: one telling term should do beside none that tells.
    heavier = np.where(y == 1, np.sqrt((1 - rate) / rate), 1.0) if len(y) else y
    heavier = heavier / max(1e-9, heavier.sum())
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w0, w, v)]
    for t in range(1, rounds + 1) if len(rows) else ():
        xv = x @ v
        out = w0 + x @ w + 0.5 * (xv**2 - (x @ (v * v))).sum(1)
        slope = (1 / (1 + np.exp(-np.clip(out, -40, 40))) - y) * heavier
        slopes = (np.array([slope.sum()]), slope @ x + penalty[0] * w, x.T @ (slope[:, None] * xv) - v * (slope @ x)[:, None] + penalty[1] * v)
        for value, g, (m1, m2) in zip((w0, w, v), slopes, state):
            m1 += 0.1 * (g - m1)
            m2 += 0.001 * (g * g - m2)
            value -= 0.05 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    return ToxicityModel(float(w0[0]), place, w, v)


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, label: str = "toxic", text: str = "text",
        id_column: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from labelled rows where `train_on` holds; about `sample_rows` of them.  Rows of equal terms and label teach
    once.

    Null texts, ids or labels teach nothing; without rows every text scores 0.5.
    """
    rows = labelled(docs, labels, train_on, label, text, id_column, sample_rows)

    def compute(texts):
        buckets, ends = _buckets(texts)
        return [[buckets[s:e].astype(np.int32).tobytes() for s, e in zip(ends[:-1], ends[1:])]]

    told = map_columns(rows, "buckets binary", compute, ["text"], ["id", "label"])
    # Copies have all their terms and the label in common: a clean text and the same with an insult both teach.
    distinct = {(row["buckets"], row["label"]): None for row in sorted(told.collect(), key=lambda r: r["id"])}
    rows = [np.frombuffer(buckets, np.int32) for buckets, _ in distinct]
    return train(rows, np.array([label for _, label in distinct], np.float64))


def score(df: DataFrame, model: ToxicityModel, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `score` (0 to 1) and `predicted` (1 from 0.5 on) of the whole text.  Null and empty texts get the score of a
    text without known terms; rows are independent; kept columns of these names give way."""

    def compute(texts):
        chance = model.scores(texts)
        return chance.tolist(), (chance >= 0.5).astype(int).tolist()

    return map_columns(df, "score double, predicted int", compute, [text], keep)


__all__ = ("ToxicityModel", "fit", "score", "train")
