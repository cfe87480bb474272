"""Vectors in shards and queries in blocks, each one row that holds a numpy array: what the searches join and merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.frames import find_package, small_batches
from tallyloom.session import stored

_PARTS = 1 << 20
_SCHEMA = "block int, n int, width int, ids binary, vectors binary"


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    limit = F.lit(float("inf"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != limit)
    return vector.isNotNull() & F.coalesce(F.forall(vector.cast("array<double>"), fine), F.lit(False))


def dealt(df: DataFrame, rows: int, name: str) -> tuple[DataFrame, int]:
    """(id, vector) dealt round into blocks of about `rows` rows, numbered from 0, and how many blocks there are.

    A block is one row of (block, n, width, ids, vectors); vectors of different widths never meet, so each width has its
    own row of a block.
    """
    df = stored(df, f"{name}-rows")
    parts = max(1, -(-df.count() // rows))
    # Dealt round, not by a key: equal vectors or ids are no hot block.
    return _packed(df.select("id", F.col("vector").cast("array<double>")).repartition(parts), name), parts


def placed(df: DataFrame, rows: int, name: str, most: int = 4_096) -> tuple[DataFrame, int]:
    """As `dealt`, but near vectors share a block where they can.

    Median splits of a sample of at most about `most` distinct vectors make cells; the rows of a cell are dealt round to
    as many blocks as its count asks for, so that equal vectors, however many, fill several.
    """
    df = stored(df.select("id", F.col("vector").cast("array<double>").alias("vector")), f"{name}-rows")
    widest = F.max(F.size("vector")).alias("widest")
    seen = df.agg(F.count("*").alias("rows"), F.approx_count_distinct("vector").alias("distinct"), widest).first()
    most = min(most, max(64, (1 << 20) // max(1, seen["widest"] or 0)))  # a million components at the outside
    share = min(_PARTS, int(_PARTS * most / max(1, seen["distinct"])))
    drawn = df.where(F.pmod(F.xxhash64("vector", F.lit(8)), F.lit(_PARTS)) < share).select("vector").distinct().collect()
    trees, told = {}, 1  # cell 0: widths that the sample doesn't hold
    for width in sorted({len(r["vector"]) for r in drawn} - {0}):
        own = np.array(sorted(r["vector"] for r in drawn if len(r["vector"]) == width), np.float64).reshape(-1, width)
        trees[width] = (told, *splits(own, max(16, -(-len(own) * rows // max(1, seen["rows"])))))
        told += len(trees[width][1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 7_919 * TaskContext.get().partitionId()
        for batch in batches:
            vectors = [v.values.to_numpy(zero_copy_only=False) for v in batch.column(1)]
            widths, cell = np.array([len(v) for v in vectors]), np.zeros(batch.num_rows, np.int32)
            for width in np.unique(widths):
                if width in trees:
                    base, *tree = trees[width]
                    some = np.flatnonzero(widths == width)
                    cell[some] = base + leaf_of(np.array([vectors[i] for i in some]).reshape(len(some), width), *tree)
            turns = pa.array(np.arange(turn, turn + batch.num_rows))
            turn += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), turns], ["id", "vector", "cell", "turn"])

    find_package(df)
    small_batches(df)
    # Written once, so that a row's turn stays what it is if a later task runs again.
    told_rows = stored(df.mapInArrow(place, "id long, vector array<double>, cell int, turn long"), f"{name}-cells")
    counts = sorted((r["cell"], r["count"]) for r in told_rows.groupBy("cell").count().collect())
    first, spread_over, parts = {}, {}, 0
    for cell, n in counts:
        first[cell], spread_over[cell] = parts, -(-n // rows)
        parts += spread_over[cell]
    if not parts:
        return _packed(told_rows.select("id", "vector"), name), 1
    value = lambda of: F.element_at(F.create_map(*[F.lit(x) for pair in of.items() for x in pair]), F.col("cell"))
    block = (value(first) + F.pmod("turn", value(spread_over))).cast("int")
    return _packed(told_rows.repartitionById(parts, block).select("id", "vector"), name), parts


def splits(sample: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A tree of median splits: each node's axis, value and left child (the right follows; -1: a leaf)."""
    axis, value, left, own = [0], [0.0], [-1], [sample]
    at = 0
    while at < len(left):
        rows = own[at]
        sides = rows.max(0) - rows.min(0) if len(rows) > leaf_rows else np.zeros(0)
        if sides.size and sides.max() > 0:
            axis[at] = int(sides.argmax())
            column = rows[:, axis[at]]
            value[at] = float(np.median(column))
            if value[at] == column.min():  # more than half are equal: the split is above them
                value[at] = float(column[column > value[at]].min())
            left[at] = len(left)
            for part in (rows[column < value[at]], rows[column >= value[at]]):
                own.append(part)
                axis.append(0)
                value.append(0.0)
                left.append(-1)
        own[at] = None
        at += 1
    return np.array(axis), np.array(value), np.array(left)


def leaf_of(vectors: np.ndarray, axis: np.ndarray, value: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf that each vector falls in."""
    node = np.zeros(len(vectors), np.int64)
    while len(some := np.flatnonzero(left[node] >= 0)):
        here = node[some]
        node[some] = left[here] + (vectors[some, axis[here]] >= value[here])
    return node


def _packed(df: DataFrame, name: str) -> DataFrame:
    """Each partition of (id, vector) as one block, numbered as the partition is."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: dict[int, list[int]] = {}
        vectors: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = v.values.to_numpy(zero_copy_only=False)
                ids.setdefault(len(own), []).append(i)
                vectors.setdefault(len(own), []).append(own)
        block = TaskContext.get().partitionId()
        for width, own in ids.items():
            table = np.array(vectors[width], np.float64).reshape(len(own), width)
            columns = [pa.array([x], pa.int32()) for x in (block, len(own), width)]
            data = [pa.array([x.tobytes()], pa.binary()) for x in (np.array(own, np.int64), table)]
            yield pa.RecordBatch.from_arrays(columns + data, ["block", "n", "width", "ids", "vectors"])

    find_package(df)
    small_batches(df)
    return stored(df.mapInArrow(pack, _SCHEMA), name)


def unpacked(n: int, width: int, ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.float64).reshape(n, width)


def searched(
    indexes: DataFrame, shards: tuple[int, int], blocks: DataFrame, search: Callable[..., tuple], index_columns: Sequence[str],
    bounds: DataFrame | None = None,
) -> DataFrame:
    """(query_id, vec_id, score) found by `search` for every block of queries in the shards of a range, within a width.

    Each block goes to each shard, for the stated queries are searched in all rows; one call of `search` holds one shard
    and one block.  It takes the index's columns, the queries' ids and vectors, and their least scores (`bounds`: one
    float64 array per block; or None), and returns arrays of query ids, vector ids and scores.
    """
    low, high = shards
    shard = F.explode(F.sequence(F.lit(low), F.lit(high - 1)) if high > low else F.array().cast("array<int>"))
    sent = blocks.withColumn("shard", shard)
    sent = sent.withColumn("least", F.lit(None).cast("binary")) if bounds is None else sent.join(bounds, ["block", "width"], "left")
    return searched_in(indexes, sent, search, index_columns)


def searched_in(indexes: DataFrame, sent: DataFrame, search: Callable[..., tuple], index_columns: Sequence[str]) -> DataFrame:
    """As `searched`, for queries (shard, n, width, ids, vectors, least) that are sent to one shard each."""
    own = indexes.select(F.col("block").alias("shard"), "width", *index_columns)
    pairs = sent.join(own.hint("shuffle_hash"), ["shard", "width"])
    k = len(index_columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = [batch.column(i)[row].as_py() for i in range(batch.num_columns)]
                ids, vectors = unpacked(*values[k : k + 4])
                least = None if values[k + 4] is None else np.frombuffer(values[k + 4], np.float64)
                query, found, score = search(*values[:k], ids, vectors, least)
                arrays = [pa.array(query, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    find_package(indexes)
    small_batches(indexes)
    inputs = pairs.select(*index_columns, "n", "width", "ids", "vectors", "least")
    return inputs.mapInArrow(run, "query_id long, vec_id long, score double")


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query's finds over all shards, ties to the smaller vec_id, with their rank."""
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
