"""Steps that must hold at large sizes: packed blocks of documents, whole training rows, narrow tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyloom.operators import customers as K
from tallyloom.operators import sequence_model as E
from tallyloom.operators import topic_model as T
from tallyloom.plans import inputs as I
from tallyloom.plans import queries
from tallyloom.session import stored

FOLDER = "/root/testdata/sf0.001"


def _plain(place, term, counts, gamma, words, alpha, steps):
    for _ in range(steps):
        before, gamma = gamma, gamma.copy()
        for d in range(len(gamma)):
            own = place == d
            theta = np.exp(T.log_expectation(gamma[d : d + 1]))[0]
            beta = words[term[own]]
            gamma[d] = alpha + theta * ((counts[own] / (beta @ theta + 1e-300)) @ beta)
        if np.abs(gamma - before).mean() < T.SETTLED:
            break
    return gamma


def test_documents_of_like_length_step_together(monkeypatch):
    """the same steps as document by document, also for empty and very long ones."""
    random = np.random.default_rng(5)
    monkeypatch.setattr(T, "NEAR", 64)
    lengths = np.array([0, 3, 90, 1, 0, 17, 18, 200, 2, 40])
    place = np.repeat(np.arange(len(lengths)), lengths)
    term, counts = random.integers(0, 50, len(place)), random.integers(1, 5, len(place)).astype(float)
    words, alpha, gamma = random.random((50, 3)), np.array([0.3, 0.2, 0.5]), random.random((len(lengths), 3)) + 0.5
    for steps in (1, 4, 7, 50):
        found, sums, told = T.improve(place, term, counts, gamma, words, alpha, steps)
        assert np.allclose(found, _plain(place, term, counts, gamma, words, alpha, steps), rtol=1e-9)
        assert np.isclose(sums.sum(), counts.sum()) and told[0] == len(lengths)
    lengths = np.sort(random.integers(0, 400, 300))
    parts = T._alike(lengths)
    assert sum(end - start for start, end in parts) == (lengths > 0).sum()
    assert all(lengths[end - 1] <= T.ALIKE * lengths[start] for start, end in parts)


def test_blocks_are_packed_and_spread(spark):
    """a block is one row of bytes in the passes, and each group has a bucket of its own."""
    rows = [(3, 1, 10, [5, 9], [1, 2]), (3, 0, 11, [9], [4]), (3, 1, 12, [], []), (3, 0, 13, [2, 5], [1, 1])]
    table = pa.Table.from_pylist([dict(zip(("_group", "_block", "_row", "terms", "counts"), r)) for r in rows])
    packed = {r["_block"]: r for r in T._pack(table).to_pylist()}
    ids = np.frombuffer(packed[-1]["used"], np.int64)
    assert list(ids) == [2, 5, 9] and sorted(packed) == [-1, 0, 1]
    found = set()
    for block in (0, 1):
        numbers, lengths, used, terms, counts = (np.frombuffer(packed[block][n], k) for n, k in zip(T._PARTS, T._KINDS))
        ends = np.cumsum(lengths)
        for number, start, end in zip(numbers, ends - lengths, ends):
            found.add((block, int(number), *zip(ids[used][terms[start:end]].tolist(), counts[start:end].tolist())))
    assert found == {(1, 10, (5, 1), (9, 2)), (0, 11, (9, 4)), (1, 12), (0, 13, (2, 1), (5, 1))}
    labels = T._spread_labels(spark, 18)
    buckets = spark.createDataFrame([(x,) for x in labels], "id long").selectExpr("pmod(hash(id), 18) AS b").distinct().count()
    assert len(set(labels)) == 18 and buckets == 18


def test_every_labelled_row_teaches(spark, monkeypatch):
    """F12"""
    held = {}

    def kept(frame, name, *rest):
        held[name] = stored(frame, name, *rest)
        return held[name]

    monkeypatch.setattr(E, "stored", kept)
    rows = spark.range(1_020_000).selectExpr("id AS review_id", "array(2 + id % 3, 2, 3) AS sequence", "cast(id % 2 AS string) AS sentiment")
    rows = rows.selectExpr("review_id", "cast(sequence AS array<int>) AS sequence", "sentiment")
    model = E.fit(rows, "review_id", "sentiment", 6, E.Training(size=2, filters=2, epochs=1, most_batches=2))
    assert held["sequence-rows"].count() == 1_020_000 and model.classes == ["0", "1"]


def test_rows_taken_by_place_are_the_rows():
    """a trainer reads its rows from a file, slice by slice."""
    random = np.random.default_rng(2)
    ids, labels, own = random.integers(0, 9, (3_000, 5)), random.integers(0, 2, 3_000), np.sort(random.choice(3_000, 2_500, replace=False))
    weights = E.start(9, 2, E.Training(size=3, filters=4))
    some, whole = E._sliced_gradients(weights, ids, labels, own), E._sliced_gradients(weights, ids[own], labels[own])
    assert np.array_equal(some[0], whole[0]) and some[1] == whole[1]
    assert E._loss(weights, ids, labels, own=own) == E._loss(weights, ids[own], labels[own])


def test_raw_order_lines_are_compressed(spark):
    """raw text is many times as long as the lines stored."""
    lines = queries.QUERIES["load_order_lines"](spark, FOLDER)
    files = [f for f in lines.inputFiles() if "part-" in f]
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert lines.count() == I.order_lines_once(spark, FOLDER).count() > 0


def test_lines_of_an_order_come_together(spark):
    """orders and customers are made of their own columns, joined with the orders last."""
    plan = I._joined(spark, FOLDER, by_order=True)._jdf.queryExecution().analyzed().toString()
    assert plan.index("l_orderkey#") < plan.index("(l_partkey#")
    both = [I._joined(spark, FOLDER, by_order=by_order) for by_order in (False, True)]
    assert both[0].columns == both[1].columns
    assert both[0].exceptAll(both[1]).isEmpty() and both[1].exceptAll(both[0]).isEmpty()
    for columns in (I.ORDER_COLUMNS, I.CUSTOMER_COLUMNS):
        held = I.lines_for(spark, "/root/testdata/sf0.001/", f"test{len(columns)}", columns)
        assert set(held.columns) == set(columns) and held.exceptAll(both[1].select(*columns)).isEmpty()


def test_nearest_sums_column_by_column():
    """F8: no array of every row, centre and column is made, and the sums are those of the plain way."""
    random = np.random.default_rng(1)
    values, weight = np.round(random.random((500, 2)) * 9, 1), random.integers(1, 4, 500).astype(float)
    centres = [random.random((3, 2)) * 9, np.array([[1.0, 1.0], [1.0, 1.0], [5.0, 2.0]])]
    found = np.split(K._nearest_sums(values, weight, centres), 2)
    for own, told in zip(centres, found):
        squares = ((values[:, None, :] - own[None]) ** 2).sum(axis=2)
        cells = [weight, *(weight * values[:, i] for i in range(2))]
        plain = np.stack([np.bincount(squares.argmin(axis=1), cell, 3) for cell in cells], axis=1)
        assert told[0] == (weight * squares.min(axis=1)).sum() and np.array_equal(told[1:].reshape(3, 3), plain)


def test_steps_hold_no_cube_of_rows():
    """F8: memory of a step is some columns of a batch."""
    import tracemalloc

    values, weight = np.zeros((20_000, 6)), np.ones(20_000)
    tracemalloc.start()
    K._nearest_sums(values, weight, [np.zeros((30, 6))])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20_000 * 6 * 8 * 10
