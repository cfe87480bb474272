"""Sentiment from the order of words: embeddings, a convolution over three words, the strongest answer of each filter, softmax.

Training is synchronous gradient descent in one barrier stage: every trainer holds the rows of its partition as arrays of
word ids, all work on the same batch at a time, and gradients are exchanged by `allGather`, so all trainers make the same
steps.  Batches and the validation part are chosen by hash of the row, so the number of trainers changes nothing but the
order of sums.  Training ends when the validation loss no longer falls, and the best weights count.

What is exchanged has the size of the model (some 100,000 numbers), whatever the number of rows, and an epoch has at most
`most_batches` exchanges: of more rows each batch is larger, and its gradients are worked out slice by slice.  `trainers`
bounds how many take part (few rows need few).  Every labelled row teaches: a trainer keeps its rows' word ids in a file that
goes with it, and has a slice of them in memory at a time.  Scoring takes every row and needs no exchange.
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.prepare import stratified_split
from tallyloom.operators.text import sequence_encode
from tallyloom.session import stored

# Words known, words of a review that are read.
WORDS, LENGTH = 5_000, 100
WIDTH = 3
#: Rows worth a trainer of their own, and rows whose gradients are worked out at once.
TRAINER_ROWS, SLICE = 4_096, 1_024
_NAMES = ("embedding", "kernel", "offset", "weights", "bias")


@dataclass(frozen=True)
class Training:
    """Settings of a fit."""

    size: int = 16
    filters: int = 32
    rate: float = 0.01
    epochs: int = 30
    patience: int = 4
    batch_rows: int = 1_024
    most_batches: int = 16
    validation: float = 0.1
    trainers: int = 8
    seed: int = 42


@dataclass(frozen=True)
class SequenceModel:
    """Weights, class names in order, and the validation loss of each epoch."""

    weights: dict[str, np.ndarray]
    classes: list[str]
    losses: list[float]

    def probabilities(self, ids: np.ndarray) -> np.ndarray:
        return _softmax(_forward(self.weights, ids)[0])


def start(words: int, classes: int, setting: Training) -> dict[str, np.ndarray]:
    """Weights to start from; the embedding of padding is 0 and stays so."""
    random = np.random.default_rng(setting.seed)
    embedding = random.normal(0, 0.1, (words, setting.size))
    embedding[0] = 0
    kernel = random.normal(0, (WIDTH * setting.size) ** -0.5, (WIDTH * setting.size, setting.filters))
    weights = random.normal(0, setting.filters**-0.5, (setting.filters, classes))
    return dict(zip(_NAMES, (embedding, kernel, np.zeros(setting.filters), weights, np.zeros(classes)), strict=True))


def _softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def _windows(ids: np.ndarray) -> np.ndarray:
    """Ids of each three words in a row; shorter rows are padded to one window."""
    return np.lib.stride_tricks.sliding_window_view(ids, WIDTH, axis=1)


def _forward(w: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Scores of the classes, and what the way back needs.

    Each word's part in a filter's answer is worked out once for each place of the window; windows are met one by one.
    """
    windows = _windows(ids)
    parts = [w["embedding"] @ own for own in np.split(w["kernel"], WIDTH)]
    padding = ~(windows != 0).any(axis=2)  # windows of padding say nothing
    top, best = None, np.zeros((len(ids), len(w["offset"])), np.int64)
    for place in range(windows.shape[1]):
        answer = sum(part[windows[:, place, i]] for i, part in enumerate(parts)) + w["offset"]
        answer[padding[:, place]] = -1.0
        if top is None:
            top = answer
            continue
        better = answer > top
        np.copyto(top, answer, where=better)
        best[better] = place
    pooled = np.maximum(top, 0)
    return pooled @ w["weights"] + w["bias"], (windows, best, top > 0, pooled)


def gradients(w: dict[str, np.ndarray], ids: np.ndarray, labels: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
    """Summed gradients of the logistic loss of rows, and the summed loss."""
    scores, (windows, best, alive, pooled) = _forward(w, ids)
    chance = _softmax(scores)
    rows = np.arange(len(ids))
    loss = float(-np.log(np.maximum(chance[rows, labels], 1e-15)).sum())
    error = chance.copy()
    error[rows, labels] -= 1
    back = (error @ w["weights"].T) * alive
    taken = windows[rows[:, None], best]
    chosen = w["embedding"][taken].reshape(*best.shape, -1)  # row, filter, window
    inside = (back[:, :, None] * w["kernel"].T[None]).reshape(taken.size, -1)
    embedding = np.stack([np.bincount(taken.ravel(), inside[:, i], len(w["embedding"])) for i in range(inside.shape[1])], axis=1)
    embedding[0] = 0
    out = (embedding, np.einsum("bfk,bf->kf", chosen, back), back.sum(axis=0), pooled.T @ error, error.sum(axis=0))
    return dict(zip(_NAMES, out, strict=True)), loss


def _summed(context, values: np.ndarray) -> np.ndarray:
    """Sums of one array over all trainers, in the order of their numbers."""
    told = context.allGather(base64.b64encode(values.astype(np.float64).tobytes()).decode())
    return np.sum([np.frombuffer(base64.b64decode(x), np.float64) for x in told], axis=0)


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[n].ravel() for n in _NAMES])


def _shaped(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name in _NAMES:
        out[name] = flat[at : at + like[name].size].reshape(like[name].shape)
        at += like[name].size
    return out


def _sliced_gradients(
    w: dict[str, np.ndarray], ids: np.ndarray, labels: np.ndarray, own: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Flat summed gradients and loss of any number of rows (those at `own`, all if None), some at a time."""
    slopes, loss, own = 0.0, 0.0, np.arange(len(ids)) if own is None else own
    for at in range(0, max(1, len(own)), SLICE):
        here = own[at : at + SLICE]
        part, lost = gradients(w, ids[here], labels[here])
        slopes, loss = slopes + _flat(part), loss + lost
    return slopes, loss


def _loss(w: dict[str, np.ndarray], ids: np.ndarray, labels: np.ndarray, step: int = SLICE, own: np.ndarray | None = None) -> float:
    total, own = 0.0, np.arange(len(ids)) if own is None else own
    for at in range(0, len(own), step):
        here = own[at : at + step]
        chance = _softmax(_forward(w, ids[here])[0])
        total -= float(np.log(np.maximum(chance[np.arange(len(chance)), labels[here]], 1e-15)).sum())
    return total


def descend(context, ids: np.ndarray, labels: np.ndarray, draw: np.ndarray, rows: int, words: int, classes: int, setting: Training):
    """Weights and validation losses that all trainers agree on, from this trainer's rows.

    `draw` is a number of each row from 0 to 1, which deals it to the validation part or a batch; `rows` counts all rows.
    """
    w = start(words, classes, setting)
    shapes, flat = w, _flat(w)
    checking = draw < setting.validation
    batches = min(setting.most_batches, max(1, round(rows * (1 - setting.validation) / setting.batch_rows)))
    place = np.minimum((draw - setting.validation) / (1 - setting.validation) * batches, batches - 1).astype(int)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    best, losses, worse, step = flat, [], 0, 0
    for _ in range(setting.epochs):
        for batch in range(batches):
            own = np.flatnonzero(~checking & (place == batch))
            slopes, loss = _sliced_gradients(_shaped(flat, shapes), ids, labels, own)
            told = _summed(context, np.concatenate([slopes, [len(own), loss]]))
            slope = told[:-2] / max(1.0, told[-2])
            step += 1
            first += 0.1 * (slope - first)
            second += 0.001 * (slope**2 - second)
            flat = flat - setting.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        own = np.flatnonzero(checking)
        lost, count = _summed(context, np.array([_loss(_shaped(flat, shapes), ids, labels, own=own), float(len(own))]))
        losses.append(lost / max(1.0, count))
        if losses[-1] <= min(losses):
            best, worse = flat, 0
        else:
            worse += 1
            if worse >= setting.patience:
                break
    return best, losses


def fit(encoded: DataFrame, key: str, label: str, words: int = WORDS, setting: Training = Training()) -> SequenceModel:
    """Learn classes `label` of rows with `sequence`, arrays of word ids of one length; rows without a label teach nothing.

    The stage needs as many free task slots as there are trainers.
    """
    spark = encoded.sparkSession
    rows = encoded.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), "sequence", F.pmod(F.xxhash64(key, "sequence", F.lit(setting.seed)), F.lit(1 << 30)).alias("draw")
    )
    known = rows.groupBy("label").count().collect()  # one row per class
    classes, count = sorted(r["label"] for r in known), sum(r["count"] for r in known)
    if not classes:
        raise ValueError("no row has a label")
    taken = stored(rows, "sequence-rows")
    trainers = max(1, min(setting.trainers, spark.sparkContext.defaultParallelism, -(-count // TRAINER_ROWS)))
    codes = {c: i for i, c in enumerate(classes)}

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = BarrierTaskContext.get()
        width, labels, draw = WIDTH, [np.zeros(0, np.int64)], [np.zeros(0)]
        with tempfile.TemporaryFile() as kept:  # without a name: it is gone when the task ends
            for batch in batches:
                if batch.num_rows:
                    own = batch.column(1).flatten().to_numpy(zero_copy_only=False)
                    width = len(own) // batch.num_rows
                    kept.write(own.astype(np.int32).tobytes())
                    labels.append(np.array([codes[x] for x in batch.column(0).to_pylist()], np.int64))
                    draw.append(batch.column(2).to_numpy() / (1 << 30))
            kept.flush()
            known, numbers = np.concatenate(labels), np.concatenate(draw)
            length = int(max(float(x) for x in context.allGather(str(width))))
            table = np.memmap(kept, np.int32, "r", shape=(len(known), width)) if len(known) else np.zeros((0, length), np.int32)
            best, losses = descend(context, table, known, numbers, count, words, len(codes), setting)
        if context.partitionId() == 0:
            data = [pa.array([best.tobytes()], pa.binary()), pa.array([losses], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(data, names=["weights", "losses"])

    dealt = taken.select("label", "sequence", "draw").repartition(trainers, "draw")
    row = dealt.mapInArrow(train, "weights binary, losses array<double>", barrier=True).collect()[0]
    shapes = start(words, len(classes), setting)
    return SequenceModel(_shaped(np.frombuffer(row["weights"], np.float64), shapes), classes, list(row["losses"]))


def score(encoded: DataFrame, model: SequenceModel, keep: Sequence[str]) -> DataFrame:
    """`keep` columns with `predicted`, the likeliest class, and `chances`, the chance of each class in order."""
    kept = encoded.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", predicted string, chances array<double>"
    weights = encoded.sparkSession.sparkContext.broadcast(model)  # of the model's fixed size
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = weights.value
            chance = known.probabilities(batch.column(width).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
            named = pa.array([known.classes[i] for i in chance.argmax(axis=1)], pa.string())
            columns = [*batch.columns[:width], named, pa.array(chance.tolist(), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:width], "predicted", "chances"])

    return encoded.select(*keep, "sequence").mapInArrow(run, schema)


@dataclass(frozen=True)
class SequenceFit:
    """Scored test rows and the model they are scored by."""

    scored: DataFrame
    model: SequenceModel

    def metrics(self) -> DataFrame:
        """Test rows, accuracy and log loss as one row."""
        place = F.array_position(F.array(*[F.lit(c) for c in self.model.classes]), F.col("sentiment")).cast("int")
        return self.scored.agg(
            F.count("*").alias("test_rows"),
            F.avg((F.col("sentiment") == F.col("predicted")).cast("double")).alias("accuracy"),
            F.avg(-F.log(F.greatest(F.element_at("chances", place), F.lit(1e-15)))).alias("loss"),
        )


def sentiment_by_order(
    cleaned: DataFrame, key: str = "review_id", test_share: float = 0.2, words: int = WORDS, length: int = LENGTH,
    setting: Training = Training(),
) -> SequenceFit:
    """Sentiment of cleaned reviews from the order of their words, tested on a stratified part.

    Reviews that share a key share their labels' row: keys should tell reviews apart.
    """
    marks = stored(
        stratified_split(cleaned.select(key, F.lower("sentiment").alias("sentiment")), "sentiment", key, test_share), "sequence-split"
    )
    encoded = sequence_encode(cleaned, key, words, length)
    rows = stored(encoded.join(marks, key), "sequence-encoded")
    model = fit(rows.where("not is_test"), key, "sentiment", words, setting)
    return SequenceFit(stored(score(rows.where("is_test"), model, [key, "sentiment"]), "sequence-scores"), model)
