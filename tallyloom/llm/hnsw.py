"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, results merged.

Inner products become distances by one more component, sqrt(R^2 - |x|^2), R being the shard's largest norm: the nearest
of the longer vectors has the largest inner product.  Rows enter a layer in random order; a row is linked to those of
the nearest earlier rows that are closer to it than to each other, and they are linked back.  Since a shard is small,
the nearest earlier rows are found by blocks of matrix products instead of walks.  Layers are flat arrays of
neighbours, (rows x degree), -1 where there is none.

Equal vectors are one node, which carries their k + 1 smallest ids: as many as a query can have among its k, one of them
being its own.  What a search finds is told by ids, so copies neither fill a beam nor hide one another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.frames import find_package, small_batches
from tallyloom.llm.shards import dealt, finite, merged, searched
from tallyloom.session import stored

SHARD_ROWS, BLOCK_ROWS = 16_384, 1_024
DEGREE, CANDIDATES, BEAM, SHRINK = 16, 48, 128, 16
_BUILD_BLOCK = 512


def _spread(vectors: np.ndarray, row: np.ndarray, near: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none), up to `degree` that are closer to the row than to one taken."""
    chosen = np.full((len(row), degree), -1, np.int32)
    have = np.zeros(len(row), np.int64)
    table = vectors[near]
    square = (table**2).sum(2)
    own = square + (vectors[row] ** 2).sum(1)[:, None] - 2 * (table @ vectors[row][:, :, None])[:, :, 0]
    gap = square[:, :, None] + square[:, None, :] - 2 * (table @ table.transpose(0, 2, 1))
    closer = gap < own[:, None, :]  # [row, taken candidate, candidate]
    taken = np.zeros(near.shape, np.bool_)
    for j in range(near.shape[1]):
        good = (near[:, j] >= 0) & ~(taken & closer[:, :, j]).any(1) & (have < degree)
        at = np.flatnonzero(good)
        chosen[at, have[at]] = near[at, j]
        have[at] += 1
        taken[at, j] = True
    return chosen


def _layer(vectors: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of each row of a layer, whose rows enter in order; twice `degree` at most."""
    n = len(vectors)
    square = (vectors**2).sum(1)
    out = np.full((n, degree), -1, np.int32)
    for s in range(0, n, _BUILD_BLOCK):
        row = np.arange(s, min(n, s + _BUILD_BLOCK))
        distance = square[None, : row[-1] + 1] - 2 * (vectors[row] @ vectors[: row[-1] + 1].T)
        distance[np.arange(row[-1] + 1)[None, :] >= row[:, None]] = np.inf
        c = min(CANDIDATES, distance.shape[1])
        near = np.argpartition(distance, c - 1, axis=1)[:, :c]
        gap = np.take_along_axis(distance, near, 1)
        order = np.argsort(gap, axis=1, kind="stable")
        near, gap = np.take_along_axis(near, order, 1), np.take_along_axis(gap, order, 1)
        out[row] = _spread(vectors, row, np.where(np.isfinite(gap), near, -1), degree)
    # Links back; a row with too many keeps its own and the best spread of the others.
    source = np.repeat(np.arange(n), degree)[out.ravel() >= 0]
    target = out.ravel()[out.ravel() >= 0]
    both = np.unique(np.concatenate([source * n + target, target * n + source]))
    source, target = both // n, both % n
    gap = ((vectors[source] - vectors[target]) ** 2).sum(1)
    order = np.lexsort((gap, source))
    source, target = source[order], target[order]
    place = np.arange(len(source)) - np.searchsorted(source, source)
    width = int(place.max()) + 1 if len(place) else 1
    links = np.full((n, 2 * degree), -1, np.int32)
    fits = place < 2 * degree
    links[source[fits], place[fits]] = target[fits]
    crowded = np.unique(source[~fits])
    for s in range(0, len(crowded), 64):
        row = crowded[s : s + 64]
        near = np.full((len(row), min(width, 8 * degree)), -1, np.int64)
        some = np.isin(source, row) & (place < near.shape[1])
        near[np.searchsorted(row, source[some]), place[some]] = target[some]
        links[row] = _spread(vectors, row, near, 2 * degree)
    return links


def lengthened(vectors: np.ndarray) -> np.ndarray:
    norm = (vectors**2).sum(1)
    return np.column_stack([vectors, np.sqrt(np.maximum(norm.max() - norm, 0))])


def build(vectors: np.ndarray, seed: int = 1) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Random order of the rows, and the layers from the lowest: (rows in it, neighbours as places in that list)."""
    random = np.random.default_rng(seed)
    order = random.permutation(len(vectors))
    level = np.floor(-np.log(1 - random.random(len(vectors))) / np.log(SHRINK)).astype(int)
    level[0] = max(1, level.max(initial=0))  # the first row enters on top
    longer, layers = lengthened(vectors)[order], []
    for layer in range(level.max() + 1):
        rows = np.flatnonzero(level >= layer)
        layers.append((rows.astype(np.int32), _layer(longer[rows], DEGREE)))
    return order, layers


def walk(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of all queries together: places (-1: none) and inner products of the best rows met, best first."""
    m = len(queries)
    seen = np.zeros((m, len(vectors)), np.bool_)
    place = np.full((m, beam), -1, np.int64)
    score = np.full((m, beam), -np.inf)
    expanded = np.ones((m, beam), np.bool_)
    place[:, 0], score[:, 0], expanded[:, 0] = start, np.einsum("ij,ij->i", queries, vectors[start]), False
    seen[np.arange(m), start] = True
    active = np.arange(m)
    while len(active):
        ahead = np.where(expanded[active], -np.inf, score[active]).argmax(1)
        going = ~expanded[active, ahead]
        active, ahead = active[going], ahead[going]
        if not len(active):
            break
        expanded[active, ahead] = True
        near = links[place[active, ahead]]
        new = (near >= 0) & ~seen[active[:, None], near]
        near = np.where(new, near, 0)
        value = np.where(new, np.einsum("ij,ikj->ik", queries[active], vectors[near]), -np.inf)
        rows, columns = np.nonzero(new)
        seen[active[rows], near[rows, columns]] = True
        all_score = np.concatenate([score[active], value], 1)
        order = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        all_place = np.concatenate([place[active], np.where(new, near, -1)], 1)
        all_expanded = np.concatenate([expanded[active], ~new], 1)
        score[active] = np.take_along_axis(all_score, order, 1)
        place[active] = np.take_along_axis(all_place, order, 1)
        expanded[active] = np.take_along_axis(all_expanded, order, 1)
    return place, score


def _pack(layers: list[tuple[np.ndarray, np.ndarray]]) -> tuple[bytes, bytes, bytes]:
    sizes = np.array([len(rows) for rows, _ in layers], np.int32)
    return sizes.tobytes(), b"".join(r.tobytes() for r, _ in layers), b"".join(x.tobytes() for _, x in layers)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(vector, ids): each distinct vector of (id, vector) with its k + 1 smallest ids, in order.

    Ids are ranked inside tasks before they are shuffled, so a vector of very many rows is a few rows from each task.
    """
    order = Window.partitionBy("vector").orderBy("id")
    few = rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k + 1)
    return few.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))


def _indexed(nodes: DataFrame, shard_rows: int) -> tuple[DataFrame, int]:
    """Nodes dealt round into shards, each with its graph, as rows (one for each width); and how many shards there are."""
    nodes = stored(nodes.select(F.col("vector").cast("array<double>"), "ids"), "hnsw-nodes")
    parts = max(1, -(-nodes.count() // shard_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for vector, ids in zip(batch.column(0), batch.column(1)):
                own = vector.values.to_numpy(zero_copy_only=False)
                vectors, names = held.setdefault(len(own), ([], []))
                vectors.append(own)
                names.append(ids.values.to_numpy(zero_copy_only=False))
        block = TaskContext.get().partitionId()
        for width, (vectors, names) in held.items():
            table = np.array(vectors, np.float64).reshape(len(vectors), width)
            order, layers = build(table)
            counts = np.array([len(names[i]) for i in order], np.int32)
            data = (counts.tobytes(), np.concatenate([names[i] for i in order]).tobytes(), table[order].tobytes(), *_pack(layers))
            arrays = [pa.array([x], pa.int32()) for x in (block, len(vectors), width)] + [pa.array([x], pa.binary()) for x in data]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "n", "width", "counts", "ids", "rows", "sizes", "members", "links"])

    find_package(nodes)
    small_batches(nodes)
    schema = "block int, n int, width int, counts binary, ids binary, rows binary, sizes binary, members binary, links binary"
    graphs = nodes.repartition(parts).mapInArrow(run, schema).select(
        "block", "width", F.col("n").alias("n_index"), F.col("width").alias("width_index"), F.col("counts").alias("counts_index"),
        F.col("ids").alias("ids_index"), "rows", "sizes", "members", "links",
    )
    return stored(graphs, "hnsw-graphs"), parts


def search_graph(n, width, counts, ids, rows, sizes, members, links, query_ids, queries, least, k, beam=BEAM):
    """About the k best ids of a shard for each query: down the layers by greedy walks, then a beam in the lowest, whose
    nodes are told by their ids."""
    counts, ids, rows = np.frombuffer(counts, np.int32), np.frombuffer(ids, np.int64), np.frombuffer(rows, np.float64).reshape(n, width)
    starts = np.cumsum(counts) - counts
    ends = np.cumsum(np.frombuffer(sizes, np.int32))
    members = np.split(np.frombuffer(members, np.int32), ends[:-1])
    links = np.split(np.frombuffer(links, np.int32).reshape(-1, 2 * DEGREE), ends[:-1])
    at = np.zeros(len(queries), np.int64)  # the first row, as its place in the layer
    beam = max(beam, k + 1)  # the query's own row may be among them
    for layer in range(len(members) - 1, -1, -1):
        own = rows[members[layer]]
        place, score = walk(own, links[layer], queries, at, 1 if layer else beam)
        if layer:
            at = np.searchsorted(members[layer - 1], members[layer][place[:, 0]])
    row, column = np.nonzero(place >= 0)
    node, value = members[0][place[row, column]], score[row, column]
    each = counts[node]
    row, value = np.repeat(row, each), np.repeat(value, each)
    name = ids[np.repeat(starts[node], each) + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)]
    others = name != query_ids[row]
    row, value, name = row[others], value[others], name[others]
    order = np.lexsort((name, -value, row))
    row, value, name = row[order], value[order], name[order]
    best = np.arange(len(row)) - np.searchsorted(row, row) < k
    return query_ids[row[best]], name[best], value[best]


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
            beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row (id, vector) of `queries` about the k rows of `df` (id, vector) of
    largest inner product, nearest first, ties to the smaller id; all rows if a shard has fewer.  A row of the query's
    own id is no candidate.  Scores are the inner products of the original vectors.

    Rows with a null id, and vectors that are null, zero, or hold a null or non-finite component, take no part; vectors
    of another width than the query's neither.  Of several queries of one id the smallest vector counts; repeated
    candidates count each.  Empty tables give no rows.
    """
    some = lambda x: F.exists("vector", lambda v: v != 0)
    ready = lambda x: x.select("id", "vector").where(F.col("id").isNotNull() & finite(F.col("vector")) & some(x))
    indexes, count = _indexed(distinct_vectors(ready(df), k), shard_rows)
    asked = ready(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks, _ = dealt(asked, block_rows, "hnsw-queries")

    def search(*values):
        return search_graph(*values, k, beam)

    index = ("n_index", "width_index", "counts_index", "ids_index", "rows", "sizes", "members", "links")
    return merged(searched(indexes, (0, count), blocks, search, index), k)
