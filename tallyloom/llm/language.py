"""Language by hierarchical discrimination: the family first, then one-versus-one within it.

Texts are hashed character n-grams inside words, as shares of all their n-grams.  A linear support vector machine per
family tells it from the others; within a family, one per pair of languages, and the language that wins most pairs
is it.  Each machine is trained by a task of its own, with numpy, on a sample of the labelled rows that is bounded in all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations
from math import sqrt

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.frames import find_package, map_columns
from tallyloom.llm.samples import gram_features, sampled_by_label
from tallyloom.llm.words import Grams

#: Families of languages by ISO 639-1 code; a language that is in none is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "pl", "cs", "uk", "bg", "sr", "hr", "sk", "sl"),
}
UNKNOWN = "und"
SAMPLE_ROWS = 4_000
#: Rows of a language, or all it has, that are learned from however rare it is.
LEAST_ROWS = 40
GRAMS = Grams(orders=(1, 2, 3), bits=12)
SCALE = 30.0
_LETTER = regex.compile(r"\p{L}")


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def svm(
    x: np.ndarray, y: np.ndarray, rounds: int = 150, penalty: float = 1e-4, least_step: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Linear support vector machine (squared hinge, classes weighted alike) for y of +1 and -1, by accelerated descent, which
    ends early when a round moves the weights by less than `least_step` of their length."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), np.float32(0)
    v, c, last = w.copy(), b, 1.0
    step = 1.0 / (2.0 * float((weight * (np.einsum("ij,ij->i", x, x) + 1)).sum()) + penalty)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ v + c)) * weight * y
        nw, nb = v + step * (2 * (slack @ x) - penalty * v), c + step * 2 * slack.sum()
        now = (1 + sqrt(1 + 4 * last * last)) / 2  # a plain float: rows stay float32
        v, c = nw + (last - 1) / now * (nw - w), nb + (last - 1) / now * (nb - b)
        moved = float(np.linalg.norm(nw - w))
        w, b, last = nw, nb, now
        if moved < least_step * float(np.linalg.norm(w)):
            break
    return w, float(b)


def _trained(spark: SparkSession, texts: Sequence[tuple[np.ndarray, np.ndarray]], sides: Sequence[tuple[np.ndarray, np.ndarray]]):
    """Weights (one column per machine) and biases.

    A machine's sides are the places of its rows of +1 and of -1.  The sample, sparse and of bounded size, is broadcast;
    machines are dealt over the tasks, and a task makes only its present machine's rows dense.
    """
    sample, told = spark.sparkContext.broadcast((texts, sides)), len(sides)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, sides = sample.value
        for batch in batches:
            for place in batch.column(0).to_pylist():
                yes, no = sides[place]
                x = np.zeros((len(yes) + len(no), GRAMS.size), np.float32)
                for row, at in zip(x, np.concatenate([yes, no])):
                    buckets, counts = texts[at]
                    row[buckets] = SCALE * counts / max(1, counts.sum())
                w, b = svm(x, np.repeat(np.array([1, -1], np.float32), [len(yes), len(no)]))
                arrays = [pa.array([place]), pa.array([w.tobytes()], pa.binary()), pa.array([b])]
                yield pa.RecordBatch.from_arrays(arrays, ["place", "weights", "bias"])

    places = spark.range(0, told, 1, max(1, min(told, spark.sparkContext.defaultParallelism * 4)))
    find_package(places)
    done = sorted(places.mapInArrow(run, "place long, weights binary, bias double").collect(), key=lambda r: r["place"])
    sample.unpersist()
    return np.column_stack([np.frombuffer(r["weights"], np.float32) for r in done]), np.array([r["bias"] for r in done])


@dataclass(frozen=True)
class LanguageModel:
    """Languages, and one column of weights per machine: first the families against the rest, then the pairs."""

    languages: tuple[str, ...]
    families: tuple[str, ...]
    pairs: tuple[tuple[str, str], ...]
    weights: np.ndarray
    bias: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text: UNKNOWN and 0 where there is no letter, or nothing was learned."""
        total, count = GRAMS.sums(texts, self.weights)
        margins = SCALE * total / np.maximum(count, 1)[:, None] + self.bias
        chance = 1 / (1 + np.exp(-np.clip(2 * margins, -40, 40)))
        names, scores = [], []
        for text, p in zip(texts, chance):
            if not self.languages or not text or not _LETTER.search(text):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            head = p[: len(self.families)]
            best = int(head.argmax()) if len(head) else 0
            score = float(head[best]) if len(self.families) > 1 else 1.0
            members = [x for x in self.languages if family(x) == self.families[best]]
            wins = dict.fromkeys(members, 0.0)
            least = dict.fromkeys(members, 1.0)
            for (a, b), q in zip(self.pairs, p[len(self.families) :]):
                if a in wins and b in wins:
                    wins[a] += q > 0.5
                    wins[b] += q <= 0.5
                    least[a], least[b] = min(least[a], q), min(least[b], 1 - q)
            name = max(members, key=lambda x: (wins[x], least[x]))
            names.append(name)
            scores.append(score * float(least[name]))
        return names, scores


def fit(df: DataFrame, train: Column, text: str = "text", label: str = "lang", id_column: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """Learn from rows where `train` holds and the label is there; about `sample_rows` of them, chosen by hash of the id, and
    some 2 x LEAST_ROWS of each rarer language, or all it has: every language of those rows is learned.

    What rarer languages add is at most about `sample_rows` again: with very many of them each has fewer rows, one at
    least.  Rows with a null text or id teach nothing; with no rows at all every text is UNKNOWN.
    """
    rows = df.where(train & F.col(f"`{label}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    rows = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{label}`").alias("label"))
    texts, labels = gram_features(sampled_by_label(rows, sample_rows, LEAST_ROWS), GRAMS)
    languages = tuple(sorted(set(labels)))
    families = tuple(sorted({family(x) for x in languages}))
    if not languages:
        return LanguageModel((), (), (), np.zeros((GRAMS.size, 0), np.float32), np.zeros(0))
    y = np.array(labels)
    groups = np.array([family(v) for v in labels])
    pairs = tuple((a, b) for a, b in combinations(languages, 2) if family(a) == family(b))
    sides = [(np.flatnonzero(groups == f), np.flatnonzero(groups != f)) for f in families]
    sides += [(np.flatnonzero(y == a), np.flatnonzero(y == b)) for a, b in pairs]
    weights, bias = _trained(df.sparkSession, texts, sides)
    return LanguageModel(languages, families, pairs, weights, bias)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds `lang_pred` and `score` (0 to 1) from the whole text.  Null texts and texts without a letter are UNKNOWN with
    score 0; rows are independent, so repeats and ties need no rule; kept columns of these names give way."""
    return map_columns(df, "lang_pred string, score double", model.predict, [text], keep)
