"""Steps that must not grow faster than their input."""

from __future__ import annotations

import numpy as np

from tallyloom.operators import customers as K
from tallyloom.operators import sequence_model as E
from tallyloom.operators import topic_model as T
from tallyloom.session import stored_buckets


class Alone:
    """A trainer without others, which counts exchanges."""

    def __init__(self):
        self.exchanges = 0

    def allGather(self, message):
        self.exchanges += 1
        return [message]


def test_exchanges_of_an_epoch_are_bounded():
    """F3, F4"""
    random = np.random.default_rng(3)
    ids, labels, draw = random.integers(1, 20, (400, 6)), random.integers(0, 2, 400), random.random(400)
    alone = Alone()
    E.descend(alone, ids, labels, draw, 100_000, 20, 2, E.Training(epochs=1))
    assert alone.exchanges <= E.Training().most_batches + 1
    weights = E.start(20, 2, E.Training())
    many, ones = np.tile(ids, (6, 1)), np.tile(labels, 6)
    assert len(many) > E.SLICE
    sliced, loss = E._sliced_gradients(weights, many, ones)
    whole, lost = E.gradients(weights, many, ones)
    assert np.allclose(sliced, E._flat(whole)) and np.isclose(loss, lost)


def test_passes_do_not_shuffle_term_counts(spark):
    """F1, F2"""
    rows = spark.createDataFrame([(1, ["a", "b", "a", None]), (2, None), (3, [])], "_row long, tokens array<string>")
    assert sorted(map(tuple, T._word_counts(rows).collect())) == [(1, "a", 2), (1, "b", 1)]
    table = stored_buckets(spark.range(100).selectExpr("id % 5 AS g", "id"), "test-buckets", "g", 2)
    plan = table.groupBy("g").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and table.count() == 100


def test_starts_step_together(spark):
    """F11"""
    rows = [(0.0, 0.0, 2.0), (2.0, 0.0, 1.0), (10.0, 0.0, 1.0), (12.0, 0.0, 3.0)]
    points = spark.createDataFrame(rows, "a double, b double, weight double")
    starts = [np.array([[0.0, 0.0], [12.0, 0.0]]), np.array([[0.0, 0.0], [2.0, 0.0]])]
    centres, costs = K._settled_centres(points, ["a", "b"], starts, 20, 0.0)
    for found, cost in zip(centres, costs):
        assert np.allclose(found, [[2 / 3, 0], [11.5, 0]]) and np.isclose(cost, 2 * 4 / 9 + 16 / 9 + 2.25 + 0.75)
