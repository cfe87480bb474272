"""Near copies: consistent weighted sampling over TF-IDF shingles, banded, verified by weighted Jaccard similarity.

A text is the weighted set of its runs of five words: weight = occurrences x ln((1 + N) / (1 + n)), n being the
documents whose shingles fall into the same of 2**18 hash cells.  A cell's background grows with the corpus as N does,
so a shingle's weight depends on the share of documents that hold it, at every size.  N and n count a group of copies
about once: plain minima of the shingles' hashes bring copies into common groups first, and a document counts as one by
the size of its largest group.  So a group's own copies don't push down what its members share.

Improved consistent weighted sampling draws `bands` x `rows` shingles from each set so that two sets agree in a draw
with the probability of their weighted Jaccard similarity; texts that agree in all draws of a band are candidates.

Texts equal to the letter are one node from the start.  In each bucket of a band all nodes are verified against a
leader, the one that meets most others.  Where that leaves a bucket with several classes, its nodes are dealt into blocks
and every two blocks meet in one task, which verifies the nodes of different classes by one matrix product and emits
only links that join classes: no link between different texts of a bucket is lost, and no group is expanded into rows
of pairs.  Classes are the connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.frames import find_package, map_columns, sifted, small_batches, text_key
from tallyloom.llm.words import mix, word_hashes
from tallyloom.session import stored

#: Nodes of a bucket that a task takes on either side.
BLOCK_NODES = 200
CELL_BITS = 18
TABLE_BITS = 14
#: Groups that count copies once: at a plain similarity of 0.8 a text misses one group with chance 0.36, all with 0.0003.
GROUPS, GROUP_DRAWS = 8, 2
#: A group of less than this share of the documents counts by its documents: it moves no weight of a cell by much.
LEAST_GROUP = 1 / 20_000
_ONE = 1 << 28
_U = np.uint64


@dataclass(frozen=True)
class NearCopies:
    """Words of a shingle, similarity of near copies, and the banding: at 0.8, 0.9994 of pairs share a band."""

    words: int = 5
    similarity: float = 0.8
    bands: int = 14
    rows: int = 4


def shingles(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, occurrences) of the distinct shingles of each text, and the bounds of the texts.

    A text of fewer than `words` words is one shingle of all its words; a text without words has none.
    """
    hashes, bounds = word_hashes(texts)
    lengths = np.diff(bounds)
    counts = np.where(lengths >= words, lengths - words + 1, (lengths > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), counts)
    if not len(owner):
        return np.empty(0, _U), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    start = np.repeat(bounds[:-1], counts) + (np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts))
    size = np.minimum(lengths[owner], words)
    padded = np.concatenate([hashes, np.zeros(words, _U)])
    value = size.astype(_U)
    for i in range(words):
        value = np.where(i < size, mix(value * _U(0x100000001B3) ^ padded[start + i]), value)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), np.bool_)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(first, append=len(value))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=len(texts)))])
    return value[first], times, ends


def _cell(values: np.ndarray) -> np.ndarray:
    return (values >> _U(64 - CELL_BITS)).astype(np.int64)


def groups(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(texts x GROUPS): what a text shares with a text of plain similarity j with chance j ** GROUP_DRAWS; for texts that
    have a shingle."""
    starts = ends[:-1]
    keys = np.random.default_rng(13).integers(1 << 62, 1 << 63, GROUPS * GROUP_DRAWS, dtype=np.uint64) | _U(1)
    out = np.zeros((len(starts), GROUPS), _U)
    for k, key in enumerate(keys):
        least = np.minimum.reduceat((values ^ key) * key, starts)
        out[:, k % GROUPS] = mix(out[:, k % GROUPS] * _U(0x100000001B3) ^ least)
    return mix(out ^ np.arange(1, GROUPS + 1, dtype=np.uint64)).view(np.int64)


def _grouped(values: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have a shingle, and their groups."""
    have = np.flatnonzero(np.diff(ends))
    return have, groups(values, np.append(ends[have], len(values))) if len(have) else np.empty((0, GROUPS), np.int64)


def _large_groups(df: DataFrame, setting: NearCopies) -> tuple[np.ndarray, np.ndarray]:
    """Groups, in order, and their documents; of those that hold LEAST_GROUP of the documents, GROUPS / LEAST_GROUP at most."""
    words = setting.words

    def compute(texts):
        values, _, ends = shingles(texts, words)
        found: list[np.ndarray | None] = [None] * len(texts)
        for row, own in zip(*_grouped(values, ends)):
            found[row] = own
        return [found]

    least = max(2, int(df.count() * LEAST_GROUP))
    told = map_columns(df, "groups array<long>", compute, ["_text"], []).select(F.explode("groups").alias("group"))
    packed = told.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") >= least).toArrow()
    name, n = packed["group"].to_numpy(), packed["n"].to_numpy()
    order = np.argsort(name)
    return name[order], n[order]


def cell_weights(df: DataFrame, setting: NearCopies) -> np.ndarray:
    """ln((1 + N) / (1 + n)) of every hash cell, over all texts of `df` (_text), copies counted about once; an array of
    fixed size."""
    words = setting.words
    names, sizes = _large_groups(df, setting)

    def shares(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """What each text counts, in parts of _ONE: whole numbers, so that sums don't depend on their order."""
        size = np.ones(len(ends) - 1, np.int64)
        have, own = _grouped(values, ends)
        if len(names) and len(have):
            at = np.minimum(np.searchsorted(names, own), len(names) - 1)
            size[have] = np.where(names[at] == own, sizes[at], 1).max(1)
        return np.maximum(_ONE // size, 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << CELL_BITS, np.int64), 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            values, _, ends = shingles(texts, words)
            share = shares(values, ends)
            n += int(share.sum())
            owner = np.repeat(np.arange(len(texts)), np.diff(ends))
            pairs = np.unique(owner * (1 << CELL_BITS) + _cell(values))
            np.add.at(total, pairs % (1 << CELL_BITS), share[pairs >> CELL_BITS])
        if n:
            found = np.flatnonzero(total)
            cells = np.concatenate([[-1], found])  # -1: the number of texts
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(np.concatenate([[n], total[found]]))], ["cell", "n"])

    find_package(df)
    small_batches(df)
    counts = df.select("_text").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    packed = counts.toArrow()  # 2**18 + 1 rows at most
    cells, n = packed["cell"].to_numpy(), packed["n"].to_numpy() / _ONE
    # A group counts as up to 1 / 0.8 ** GROUP_DRAWS texts, what a part of it holds as less than one: both as two.
    weights = np.full(1 << CELL_BITS, 2.0)
    weights[cells[cells >= 0]] = np.maximum(n[cells >= 0], 2)
    total = max(float(n[cells == -1].sum()), 1.0)
    # Shingles that every text has still count a little: texts that hold nothing else stay comparable.
    return np.maximum(np.log((1 + total) / (1 + weights)), 0.01).astype(np.float32)


@cache
def _draws() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1), ln Gamma(2, 1) and uniform variates; a shingle's variates of draw k are those at its k-th hash."""
    random = np.random.default_rng(7)
    n = 1 << TABLE_BITS
    return (
        random.gamma(2.0, 1.0, n).astype(np.float32),
        np.log(random.gamma(2.0, 1.0, n)).astype(np.float32),
        random.random(n).astype(np.float32),
    )


def signatures(values: np.ndarray, weights: np.ndarray, ends: np.ndarray, draws: int) -> np.ndarray:
    """(texts x draws): 32 bits that stand for the drawn shingle and its level; for texts that have a shingle."""
    r, c, b = _draws()
    log_weight = np.log(weights).astype(np.float32)
    starts = ends[:-1]
    out = np.empty((len(starts), draws), np.uint32)
    keys = np.random.default_rng(11).integers(1 << 62, 1 << 63, draws, dtype=np.uint64) | _U(1)
    for k in range(draws):
        own = (values ^ keys[k]) * keys[k]
        at = (own >> _U(64 - TABLE_BITS)).astype(np.int64)
        rate = r[at]
        level = np.floor(log_weight / rate + b[at])
        score = c[at] - rate * (level - b[at] + np.float32(1))
        mark = (own ^ (level.astype(np.int64).astype(_U) * _U(0x9E3779B97F4A7C15))) * _U(0xD6E8FEB86659FD93)
        height = ((np.clip(score, -120, 120) + np.float32(128)).astype(np.float64) * (1 << 24)).astype(_U)
        best = np.minimum.reduceat((height << _U(32)) | (mark >> _U(32)), starts)
        out[:, k] = (best & _U(0xFFFFFFFF)).astype(np.uint32)
    return out


def _bands(texts: list[str | None], weights: np.ndarray, setting: NearCopies) -> list[np.ndarray | None]:
    values, times, ends = shingles(texts, setting.words)
    result: list[np.ndarray | None] = [None] * len(texts)
    have = np.flatnonzero(np.diff(ends))
    size = 1 << 16
    at = 0
    while at < len(have):  # groups of texts with some 65,000 shingles, to stay in the processor's cache
        until = max(at + 1, int(np.searchsorted(ends[have + 1], ends[have[at]] + size, side="right")))
        group = have[at:until]
        low, high = ends[group[0]], ends[group[-1] + 1]
        own = values[low:high]
        bounds = np.append(ends[group], high) - low
        marks = signatures(own, times[low:high] * weights[_cell(own)], bounds, setting.bands * setting.rows).astype(_U)
        bands = np.zeros((len(group), setting.bands), _U)
        for j in range(setting.rows):
            bands = mix(bands * _U(0x100000001B3) ^ marks[:, j :: setting.rows])
        bands = mix(bands ^ np.arange(1, setting.bands + 1, dtype=np.uint64)).view(np.int64)
        for row, band in zip(group, bands):
            result[row] = band
        at = until
    return result


def _similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two sorted (hash, weight) sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = float(np.minimum(a[1][i], b[1][j]).sum())
    return low / max(float(a[1].sum() + b[1].sum()) - low, 1e-12)


def verified(pairs: DataFrame, texts: DataFrame, weights: np.ndarray, setting: NearCopies) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, _text) are similar enough."""
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("_text").alias("_text_a")), "a")
    joined = joined.join(texts.select(F.col("node").alias("b"), F.col("_text").alias("_text_b")), "b")
    words, least = setting.words, setting.similarity

    def compute(keys_a, keys_b, left, right):
        distinct = dict(zip(keys_a, left)) | dict(zip(keys_b, right))
        values, times, ends = shingles(list(distinct.values()), words)
        weighted = times * weights[_cell(values)]
        sets = {k: (values[s:e], weighted[s:e]) for k, s, e in zip(distinct, ends[:-1], ends[1:])}
        return [[_similarity(sets[a], sets[b]) >= least for a, b in zip(keys_a, keys_b)]]

    told = map_columns(joined, "similar boolean", compute, ["a", "b", "_text_a", "_text_b"], ["a", "b"])
    return told.where("similar").select("a", "b")


def _products(values: np.ndarray, times: np.ndarray, ends: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of some texts' weighted sets.

    An occurrence of a shingle is an element of its own, so the common weight of two sets is a product of 0/1 rows; what
    only one text has can't be common and is left out of it.
    """
    n = len(ends) - 1
    owner = np.repeat(np.repeat(np.arange(n), np.diff(ends)), times)
    value = np.repeat(values, times)
    turn = np.arange(len(value)) - np.repeat(np.cumsum(times) - times, times)
    weight = weights[_cell(value)]
    total = np.bincount(owner, weight, minlength=n)
    element = mix(value ^ (turn.astype(_U) << _U(1)))
    _, first, place, seen = np.unique(element, return_index=True, return_inverse=True, return_counts=True)
    shared = np.flatnonzero(seen > 1)
    column = np.full(len(seen), -1)
    column[shared] = np.arange(len(shared))
    at = column[place]
    owner, at = owner[at >= 0], at[at >= 0]
    scale = np.sqrt(weight[first[shared]])
    common = np.zeros((n, n))
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, len(shared), 4096):  # a bounded part of the elements at a time
        s, e = np.searchsorted(at, [low, low + 4096])
        table = np.zeros((n, min(4096, len(shared) - low)), np.float32)
        table[owner[s:e], at[s:e] - low] = scale[at[s:e]]
        common += table @ table.T
    return common / np.maximum(total[:, None] + total[None, :] - common, 1e-12)


def _joins(roots: list, sides: list[int], alike: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs that are alike and of different roots and, if there are two sides, sides: enough to join all classes
    that any of them joins."""
    name = {r: i for i, r in enumerate(dict.fromkeys(roots))}
    root = np.array([name[r] for r in roots])
    side = np.array(sides)
    good = alike & (root[:, None] != root[None, :])
    if len(set(sides)) > 1:
        good &= side[:, None] != side[None, :]
    parent = list(range(len(name)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links = []
    for a, b in zip(*np.nonzero(np.triu(good))):
        x, y = find(root[a]), find(root[b])
        if x != y:
            parent[x] = y
            links.append((int(a), int(b)))
    return links


def _across_classes(placed: DataFrame, texts: DataFrame, weights: np.ndarray, setting: NearCopies) -> DataFrame:
    """Links (a, b) between nodes of one bucket and of different classes, for (bucket, node, root, members)."""
    parts = F.ceil(F.col("members") / BLOCK_NODES).cast("int")
    dealt = placed.withColumn("parts", parts).withColumn("side", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    met = dealt.join(texts, "node").select("bucket", "node", "root", "side", "_text", other)
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    met = met.select("bucket", low, high, "node", "root", "side", "_text")
    met = met.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    words, least = setting.words, setting.similarity

    def links(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        nodes, roots, sides, own = zip(*group)
        if len(set(roots)) < 2:
            return []
        alike = _products(*shingles(list(own), words), weights) >= least
        return [(nodes[a], nodes[b]) for a, b in _joins(list(roots), list(sides), alike)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []
        for batch in batches:
            found = []
            for bucket, lo, hi, *member in zip(*[c.to_pylist() for c in batch.columns]):
                if (bucket, lo, hi) != key:
                    found += links(group) if len(group) > 1 else []
                    key, group = (bucket, lo, hi), []
                group.append(tuple(member))
            yield _linked(found)
        yield _linked(links(group) if len(group) > 1 else [])

    find_package(met)
    small_batches(met)
    return met.mapInArrow(run, "a binary, b binary")


def _linked(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], ["a", "b"])


def _pairs(shared: DataFrame) -> DataFrame:
    """Every member of a bucket of (bucket, node, members) with the bucket's leader: the node that meets most others over
    all its buckets."""
    meets = stored(shared.groupBy("node").agg(F.sum("members").alias("meets")), "neardup-meets")
    ranked = stored(shared.join(meets, "node").select("bucket", "node", "meets"), "neardup-ranked")
    leaders = stored(ranked.groupBy("bucket").agg(F.max(F.struct("meets", "node"))["node"].alias("leader")), "neardup-firsts")
    return ranked.join(leaders, "bucket").where(F.col("node") != F.col("leader")).select(
        F.col("leader").alias("a"), F.col("node").alias("b")
    )


def classes(df: DataFrame, text: str = "text", id_column: str = "doc_id", setting: NearCopies = NearCopies()) -> DataFrame:
    """One row per row of `df`: doc_id, node (128 bits of the text), class_id (smallest doc_id of its class), class_size
    (rows in it), keep (true for the smallest doc_id of the class; repeated rows of it share that).

    Rows with equal texts are one class.  Null and empty texts have no node and are classes of their own; texts without
    words are alike only if equal; null ids come last.  An empty table gives no rows.
    """
    docs = df.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("_text"))
    docs = docs.withColumn("node", F.when(F.length("_text") > 0, text_key("_text")))
    weights = cell_weights(docs.where("node is not null"), setting)
    signed = map_columns(docs, "bands array<long>", lambda texts: [_bands(texts, weights, setting)], ["_text"], ["doc_id", "node"])
    signed = stored(signed, "neardup-signatures")
    # A text has its bands once, before they are made rows.
    banded = stored(signed.where("bands is not null").select("node", "bands").distinct(), "neardup-bands")
    members = banded.select("node", F.explode("bands").alias("bucket"))
    # Aggregates are stored before they are joined: with plain shuffles on both sides, a large bucket can be split.
    sizes = stored(members.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1"), "neardup-sizes")
    shared = stored(sifted(members, sizes, ["bucket"]).join(sizes, "bucket"), "neardup-shared")
    first = stored(_pairs(shared).distinct(), "neardup-pairs")

    # One copy of each candidate text, whatever the number of rows that hold it: that of its least id, so that the rows of
    # a text are dealt by id as well and never meet in one task.
    picks = signed.where("bands is not null").groupBy("node").agg(F.min("doc_id").alias("_id"))
    picks = stored(picks.join(shared.select(F.col("node").alias("_node")).distinct(), F.col("node") == F.col("_node")), "neardup-picks")
    picks = picks.select("node", F.col("_id").alias("doc_id"))
    # What the sieve lets through besides is the text of another node, or of the same one once more.
    texts = sifted(docs.where("node is not null"), picks, ["node", "doc_id"]).select("node", "_text").dropDuplicates(["node"])
    texts = stored(texts, "neardup-texts")
    links = stored(verified(first, texts, weights, setting), "neardup-links")
    roots = components(links, "neardup-leaders")

    placed = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    placed = stored(placed, "neardup-placed")
    several = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    placed = placed.join(stored(several.select("bucket"), "neardup-several"), "bucket")
    more = stored(_across_classes(placed, texts, weights, setting), "neardup-more")
    roots = components(links.unionByName(more), "neardup-classes")

    nodes = signed.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"), F.count("*").alias("rows"))
    nodes = stored(nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "neardup-nodes")
    # A class of null ids only has a null class_id; its first node then stands for it.
    least = F.min(F.struct(F.col("low").isNull(), "low", "node"))
    totals = nodes.groupBy("root").agg(least.alias("first"), F.sum("rows").alias("class_size"))
    totals = totals.select("root", F.col("first.low").alias("class_id"), "class_size", F.col("first.node").alias("first_node"))
    told = nodes.join(stored(totals, "neardup-totals"), "root").select("node", "class_id", "class_size", "first_node")
    grouped = signed.where("node is not null").select("doc_id", "node").join(told, "node")
    stays = (F.col("node") == F.col("first_node")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    grouped = grouped.select("doc_id", "node", "class_id", "class_size", stays.alias("keep"))
    alone = signed.where("node is null").select(
        "doc_id", "node", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("keep")
    )
    return grouped.unionByName(alone)


def deduplicate(df: DataFrame, text: str = "text", id_column: str = "doc_id", setting: NearCopies = NearCopies()) -> DataFrame:
    """The rows of `df` with one of each class of near copies left: that of the smallest id, one row of it if it repeats.

    Rows with a null or empty text stay.
    """
    told = classes(df, text, id_column, setting).where("node is not null")
    same = told.where("keep").groupBy("node", "doc_id").agg(F.count("*").alias("_copies"))
    gone = told.where("not keep").select("node", F.col("doc_id").alias("_id")).distinct()
    names = df.columns
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    body, key = f"c{names.index(text)}", f"c{names.index(id_column)}"
    rows = rows.withColumn("_node", F.when(F.length(body) > 0, text_key(body)))
    rows = rows.join(gone, (rows["_node"] == gone["node"]) & rows[key].eqNullSafe(gone["_id"]), "left_anti")
    repeated = stored(same.where("_copies > 1").select(F.col("node").alias("_same")), "neardup-repeated")
    if repeated.isEmpty():  # then the texts need not be gone through twice
        return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
    once = rows.join(repeated, rows["_node"] == repeated["_same"], "left_anti")
    several = rows.join(repeated, rows["_node"] == repeated["_same"], "left_semi").dropDuplicates(["_node"])
    kept = once.unionByName(several)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])


__all__ = ("NearCopies", "classes", "deduplicate")
