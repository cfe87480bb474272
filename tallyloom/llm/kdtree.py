"""Exact top-k by inner product: a KD-tree per shard.

Each shard's tree halves its rows at the median of the widest side of their box, down to small leaves; every node has
the tight box of its rows.  A query goes best-first: the node whose box allows the largest inner product comes next,
and the search ends when no box can beat the k-th score so far.  Shards hold near rows where they can.  Each query is
first searched in one shard, blocks of queries in different ones; the k-th score found there is the least score with
which it enters others, and it is sent only to those shards whose box allows that score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import find_package, map_columns, small_batches
from tallyloom.llm.shards import dealt, finite, merged, placed, searched_in, unpacked
from tallyloom.session import stored

SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4_096, 1_024, 128
#: Shards whose boxes a block of queries meets at a time.
BOXES = 1_024


def build(vectors: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, ...]:
    """Row order, and for each node: first and end row in it, place of the left child (the right follows; -1: leaf), and
    the lower and upper corner of its box.  Children come after their parent."""
    order = np.arange(len(vectors))
    first, end, left, low, high = [0], [len(order)], [-1], [], []
    at = 0
    while at < len(first):
        s, e = first[at], end[at]
        own = vectors[order[s:e]]
        low.append(own.min(0))
        high.append(own.max(0))
        sides = high[at] - low[at]
        if e - s > leaf_rows and sides.size and sides.max() > 0:  # equal rows can't and needn't be halved
            half = (e - s) // 2
            order[s:e] = order[s:e][np.argpartition(own[:, sides.argmax()], half)]
            left[at] = len(first)
            first += [s, s + half]
            end += [s + half, e]
            left += [-1, -1]
        at += 1
    ints = [np.array(x, np.int32) for x in (order, first, end, left)]
    return (*ints, np.array(low, np.float64), np.array(high, np.float64))


def _indexed(shards: DataFrame, leaf_rows: int) -> DataFrame:
    """Each shard with its tree."""
    names = ["rows", "first", "end", "left", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, n, width, ids, vectors = (batch.column(i)[row].as_py() for i in range(5))
                ids, table = unpacked(n, width, ids, vectors)
                order, *tree = build(table, leaf_rows)
                arrays = [pa.array([block], pa.int32()), *[pa.array([x], pa.int32()) for x in (n, width)]]
                arrays += [pa.array([x.tobytes()], pa.binary()) for x in (ids[order], table[order], *tree)]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "n", "width", "ids", *names])

    find_package(shards)
    small_batches(shards)
    schema = "block int, n int, width int, ids binary, rows binary, first binary, end binary, left binary, low binary, high binary"
    return shards.mapInArrow(run, schema).select(
        "block", "width", F.col("n").alias("n_index"), F.col("width").alias("width_index"), F.col("ids").alias("ids_index"), *names
    )


def search_tree(n, width, ids, rows, first, end, left, low, high, query_ids, queries, least, k):
    """The k best rows (all, if fewer) of a tree for each query, as (query ids, row ids, scores); no row whose id is the
    query's.  Rows below a query's `least` score may be left out.

    All queries of a block move together: in each round every query that still has an open node takes its best one; an
    inner node's children join its open nodes, and a leaf's rows are scored for all queries that reached it at once.
    """
    ids, rows = np.frombuffer(ids, np.int64), np.frombuffer(rows, np.float64).reshape(n, width)
    first, end, left = (np.frombuffer(x, np.int32) for x in (first, end, left))
    low, high = (np.frombuffer(x, np.float64).reshape(len(first), width) for x in (low, high))
    m = len(queries)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = up @ high.T + down @ low.T  # the largest inner product that each node's box allows
    is_open = np.zeros(bound.shape, np.bool_)
    is_open[:, 0] = True
    kth = np.full(m, -np.inf) if least is None else least.copy()
    best = np.full((m, k), -np.inf)
    best_id = np.full((m, k), np.iinfo(np.int64).max)
    active = np.arange(m)
    while len(active):
        ahead = np.where(is_open[active], bound[active], -np.inf)
        node = ahead.argmax(1)
        worth = (ahead[np.arange(len(active)), node] >= kth[active]) & is_open[active, node]
        active, node = active[worth], node[worth]
        is_open[active, node] = False
        inner = left[node] >= 0
        for child in (0, 1):
            is_open[active[inner], left[node[inner]] + child] = True
        leaves, where = node[~inner], active[~inner]
        met = []
        for leaf in np.unique(leaves):
            own = where[leaves == leaf]
            some = slice(first[leaf], end[leaf])
            score = queries[own] @ rows[some].T
            at, column = np.nonzero((score >= kth[own][:, None]) & (ids[some] != query_ids[own][:, None]))
            met.append([own[at], ids[some][column], score[at, column]])
        if not met:
            continue
        query, name, score = (np.concatenate(x) for x in zip(*met))
        touched = np.unique(query)
        query = np.concatenate([np.repeat(touched, k), query])
        name = np.concatenate([best_id[touched].ravel(), name])
        score = np.concatenate([best[touched].ravel(), score])
        order = np.lexsort((name, -score, query))
        start = np.searchsorted(query[order], touched)
        first_k = order[start[:, None] + np.arange(k)]
        best[touched], best_id[touched] = score[first_k], name[first_k]
        kth[touched] = np.maximum(kth[touched], best[touched, -1])
    found = best > -np.inf
    return np.repeat(query_ids, found.sum(1)), best_id[found], best[found]


def top_k(df: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
          leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row (id, vector) of `queries` its k rows of `df` (id, vector) of largest
    inner product, ties to the smaller id, exactly; all rows if there are fewer.  A row of the query's own id is no
    candidate.

    Rows with a null id, and vectors that are null or hold a null or non-finite component, take no part; vectors of
    another width than the query's neither.  Of several queries of one id the smallest vector counts; repeated
    candidates count each.  Empty tables give no rows.
    """
    ready = lambda x: x.select("id", "vector").where(F.col("id").isNotNull() & finite(F.col("vector")))
    shards, count = placed(ready(df), shard_rows, "kd-shards")
    indexes = stored(_indexed(shards, leaf_rows), "kd-trees")
    asked = ready(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks, _ = dealt(asked, block_rows, "kd-queries")
    index = ["n_index", "width_index", "ids_index", "rows", "first", "end", "left", "low", "high"]

    def search(*values):
        return search_tree(*values, k)

    home = F.pmod("block", F.lit(count)).cast("int")
    first = blocks.withColumn("shard", home).withColumn("least", F.lit(None).cast("binary"))
    near = stored(searched_in(indexes, first, search, index), "kd-first")  # the home shard gives the least scores
    kth = near.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k)
    asking = blocks.withColumn("home", home).join(_bounds(blocks, kth), ["block", "width"])
    rest = searched_in(indexes, _worth(asking, indexes, count), search, index)
    return merged(near.unionByName(rest), k)


def _worth(asking: DataFrame, indexes: DataFrame, count: int) -> DataFrame:
    """(shard, n, width, ids, vectors, least): for each block of queries and each shard but its home, those queries whose
    least score the shard's box allows.  Boxes come in rows of BOXES shards, so a block is copied for many shards at once."""
    size = 8 * F.col("width")
    box = F.struct(F.col("block").alias("shard"), *[F.substring(x, F.lit(1), size).alias(x) for x in ("low", "high")])
    group = F.floor(F.col("block") / BOXES).cast("int")
    boxes = indexes.groupBy(group.alias("group"), "width").agg(F.sort_array(F.collect_list(box)).alias("boxes"))
    groups = F.sequence(F.lit(0), F.lit((count - 1) // BOXES))
    met = asking.withColumn("group", F.explode(groups)).join(boxes, ["group", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                home, n, width, ids, vectors, least, boxes = (batch.column(i)[row].as_py() for i in range(7))
                ids, vectors = unpacked(n, width, ids, vectors)
                least = np.frombuffer(least, np.float64)
                low, high = (np.frombuffer(b"".join(x[y] for x in boxes), np.float64).reshape(len(boxes), width) for y in ("low", "high"))
                up, down = np.maximum(vectors, 0), np.minimum(vectors, 0)
                slack = 1e-12 * (up @ np.abs(high).T - down @ np.abs(low).T)  # sums in another order may round otherwise
                worth = up @ high.T + down @ low.T + slack >= least[:, None]
                for at, shard in enumerate(x["shard"] for x in boxes):
                    some = np.flatnonzero(worth[:, at])
                    if shard == home or not len(some):
                        continue
                    numbers = [pa.array([x], pa.int32()) for x in (shard, len(some), width)]
                    data = [pa.array([x[some].tobytes()], pa.binary()) for x in (ids, vectors, least)]
                    yield pa.RecordBatch.from_arrays(numbers + data, ["shard", "n", "width", "ids", "vectors", "least"])

    inputs = met.select("home", "n", "width", "ids", "vectors", "least", "boxes")
    return inputs.mapInArrow(run, "shard int, n int, width int, ids binary, vectors binary, least binary")


def _bounds(blocks: DataFrame, kth: DataFrame) -> DataFrame:
    """(block, width, least): each block's least scores as one array; minus infinity for a query without k finds yet."""

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, width, own = (batch.column(i)[row].as_py() for i in range(3))
                own = np.frombuffer(own, np.int64)
                fixed = [pa.array(np.full(len(own), x), pa.int32()) for x in (block, width)]
                arrays = [*fixed, pa.array(np.arange(len(own))), pa.array(own)]
                yield pa.RecordBatch.from_arrays(arrays, ["block", "width", "at", "query_id"])

    def packed(rows):
        return [[np.array(x, np.float64).tobytes() for x in rows]]

    places = blocks.select("block", "width", "ids").mapInArrow(ids, "block int, width int, at long, query_id long")
    told = places.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    told = told.groupBy("block", "width").agg(F.sort_array(F.collect_list(F.struct("at", "kth"))).alias("all"))  # block_rows at most
    return map_columns(told.select("block", "width", F.col("all.kth").alias("kth")), "least binary", packed, ["kth"], ["block", "width"])
