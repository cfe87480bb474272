"""Spelling variants: words one edit apart, found by probing edits against Bloom filters of the vocabulary.

Words are runs of letters of seven or more that occur twice or more in the corpus.  For every word the edits that delete
a letter, or replace one by a later letter of the alphabet, are hashed (every pair of near words is such an edit, taken
from one of its two sides) and probed against blocked Bloom filters, one shard for each word length.  Only positives are
shuffled, as pairs of 64-bit keys, to a join with the vocabulary, and what joins is confirmed on the words themselves,
so neither filters nor keys decide the result.

A broadcast never exceeds `FILTER_BYTES`: where all shards together are larger, ranges of their blocks are probed one
after the other, each by a pass over the vocabulary.

Null and empty texts have no words; a null id counts as an empty one.  Repeated rows count as often as they stand there;
ties of counts go to the word of smaller code points; very long runs are edited in pieces of bounded size.  An empty
table gives an empty result.  Only the text and id columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import find_package, map_columns, small_batches
from tallyloom.llm.words import mix
from tallyloom.session import stored

LEAST_LETTERS, LEAST_COUNT, TIMES = 7, 2, 10
#: Runs of letters (after lower-casing), and which runs lose a letter.
RUN = rf"[a-zÀ-ÿ]{{{LEAST_LETTERS},}}"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SLIP = 31
#: Filters: bits for each word, bytes of one broadcast, and the length from which words share a shard.
BITS, FILTER_BYTES, LONGEST = 16, 16 << 20, 64
#: A block is eight lanes of 32 bits; a word sets one bit in each.
LANES, _BLOCK_BYTES = 8, 32
_LANE_SALTS = mix(np.arange(1, LANES + 1, dtype=np.uint64)) | np.uint64(1)
_LETTER_VALUES = mix(np.arange(1000, 1256, dtype=np.uint64)) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Edits that are hashed at a time.
_EDITS = 1 << 18


def occurrences(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(word): every occurrence of a word in whole texts, after the stated slips."""
    lowered = F.translate(F.col(f"`{text}`"), _UPPER, _LOWER)
    name = F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))
    runs = docs.select(name.alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("_run"))
    hashed = runs.withColumn("_hash", F.crc32(F.concat_ws(":", "_id", "_run")))
    place = F.pmod(F.col("_hash"), F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), place), F.substring(F.col("_run"), place + 2, F.length("_run")))
    word = F.when(F.col("_hash") % SLIP == 0, cut).otherwise(F.col("_run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= LEAST_LETTERS)


def vocabulary(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(word, n): words that occur often enough."""
    return occurrences(docs, text, id_column).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _powers(length: int) -> np.ndarray:
    powers = np.full(length, _BASE, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def _finish(sums: np.ndarray, length: int) -> np.ndarray:
    return mix(sums ^ np.uint64((length * 0xD6E8FEB86659FD93) % (1 << 64)))


def keys(words: list[str]) -> np.ndarray:
    """A 64-bit key of each word: letter values weighed by powers of their places, then mixed."""
    out = np.empty(len(words), np.uint64)
    for length, rows in _by_length(words):
        letters = np.frombuffer("".join(words[i] for i in rows).encode("latin-1"), np.uint8).reshape(len(rows), length)
        out[rows] = _finish((_LETTER_VALUES[letters] * _powers(length)).sum(axis=1, dtype=np.uint64), length)
    return out


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


class Shards:
    """Where the blocks of each length begin in one row of all blocks, by the number of words of each length."""

    def __init__(self, words_of_length: dict[int, int]):
        self.blocks = np.zeros(LONGEST + 1, np.uint64)
        for length, n in words_of_length.items():
            self.blocks[length] = -(-n * BITS // (8 * _BLOCK_BYTES))
        self.starts = np.concatenate([[0], np.cumsum(self.blocks)]).astype(np.uint64)
        self.total = int(self.starts[-1])

    def block(self, found: np.ndarray, length: int) -> np.ndarray:
        """The block of keys of words of a length; none where no word has that length."""
        shard = min(length, LONGEST)
        return self.starts[shard] + (((found >> np.uint64(32)) * self.blocks[shard]) >> np.uint64(32))

    def holds(self, length: int) -> bool:
        return bool(self.blocks[min(length, LONGEST)])


def _bit(found: np.ndarray, lane: int) -> np.ndarray:
    """The bit that keys set in a lane."""
    spread = ((found & np.uint64(0xFFFFFFFF)) * _LANE_SALTS[lane]) & np.uint64(0xFFFFFFFF)
    return np.uint32(1) << (spread >> np.uint64(27)).astype(np.uint32)


def filter_blocks(known: DataFrame, shards: Shards) -> DataFrame:
    """(block, lane0, ...): the filled blocks of all shards, from words with their keys."""

    def compute(words, found):
        found = np.array(found, np.int64).view(np.uint64)
        blocks = np.empty(len(words), np.int64)
        for length, rows in _by_length(words):
            blocks[rows] = shards.block(found[rows], length).astype(np.int64)
        return [blocks, *[_bit(found, lane).view(np.int32) for lane in range(LANES)]]

    lanes = [f"lane{i}" for i in range(LANES)]
    rows = map_columns(known, "block long, " + ", ".join(f"{x} int" for x in lanes), compute, ["word", "key"], [])
    return rows.groupBy("block").agg(*[F.bit_or(x).alias(x) for x in lanes])


class Probe:
    """Edits of words tested against one range of blocks."""

    def __init__(self, shards: Shards, first: int, lanes: np.ndarray, alphabet: bytes):
        self.shards, self.first, self.lanes = shards, first, lanes
        self.alphabet = np.frombuffer(alphabet, np.uint8)

    def positive(self, found: np.ndarray, length: int) -> np.ndarray:
        """Indexes of the keys that the range's filters may hold."""
        at = self.shards.block(found, length).astype(np.int64) - self.first
        left = np.flatnonzero((at >= 0) & (at < len(self.lanes)))
        for lane in range(LANES):
            bits = _bit(found[left], lane)
            left = left[self.lanes[at[left], lane] & bits != 0]
        return left

    def edits(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row of the word, key of the edit) of all positives."""
        for length, rows in _by_length(words):
            letters = np.frombuffer("".join(words[i] for i in rows).encode("latin-1"), np.uint8).reshape(len(rows), length)
            step = max(1, _EDITS // (length * max(1, len(self.alphabet))))
            for at in range(0, len(rows), step):
                yield from self._of(rows[at : at + step], letters[at : at + step], length)

    def _of(self, rows, letters, length) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        values, powers = _LETTER_VALUES[letters], _powers(length)
        weighed = values * powers
        sums = weighed.sum(axis=1, dtype=np.uint64)
        if self.shards.holds(length - 1):
            # Letters after the deleted one move up by one place.
            moved = values[:, 1:] * powers[:-1]
            before = np.concatenate([np.zeros((len(rows), 1), np.uint64), np.cumsum(weighed, axis=1, dtype=np.uint64)[:, :-1]], axis=1)
            after = np.concatenate(
                [np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1], np.zeros((len(rows), 1), np.uint64)], axis=1
            )
            new = np.ones(letters.shape, np.bool_)  # of equal neighbours one deletion is enough
            new[:, 1:] = letters[:, 1:] != letters[:, :-1]
            which, where = np.nonzero(new)
            yield self._found(rows[which], (before + after)[which, where], length - 1)
        if self.shards.holds(length):
            step = max(1, _EDITS // (len(rows) * max(1, len(self.alphabet))))
            for at in range(0, length, step):
                part = slice(at, at + step)
                which, where, letter = np.nonzero(self.alphabet[None, None, :] > letters[:, part, None])
                change = _LETTER_VALUES[self.alphabet[letter]] - values[which, at + where]
                yield self._found(rows[which], sums[which] + change * powers[at + where], length)

    def _found(self, rows, sums, length) -> tuple[np.ndarray, np.ndarray]:
        found = _finish(sums, length)
        hits = self.positive(found, length)
        return rows[hits], found[hits]


def _positives(known: DataFrame, probe) -> DataFrame:
    """(key, edit): keys of words and of their edits that one range of filters lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tested = probe.value
        for batch in batches:
            words, own = batch.column(0).to_pylist(), np.asarray(batch.column(1))
            for rows, found in tested.edits(words):
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array(own[rows]), pa.array(found.view(np.int64))], names=["key", "edit"])

    find_package(known)
    small_batches(known)
    return known.select("word", "key").mapInArrow(run, "key long, edit long")


def near_words(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of words of (word, n) exactly one edit apart, once for each direction."""
    spark = words.sparkSession
    known = stored(map_columns(words, "key long", lambda w: [keys(w).view(np.int64)], ["word"], ["word", "n"]), "spelling-words")
    lengths = known.groupBy(F.least(F.length("word"), F.lit(LONGEST)).alias("length")).count().collect()
    shards = Shards({r["length"]: r["count"] for r in lengths})
    letters = known.select(F.explode(F.split("word", "")).alias("letter")).distinct().collect()
    alphabet = "".join(sorted(r["letter"] for r in letters)).encode("latin-1")
    blocks = stored(filter_blocks(known, shards), "spelling-blocks")
    step, positives = max(1, filter_bytes // _BLOCK_BYTES), []
    for first in range(0, shards.total, step):
        size = min(step, shards.total - first)
        table = blocks.where(F.col("block").between(first, first + size - 1)).toArrow()
        lanes = np.zeros((size, LANES), np.uint32)
        places = table.column("block").to_numpy() - first
        for i in range(LANES):
            lanes[places, i] = table.column(f"lane{i}").to_numpy().view(np.uint32)
        probe = spark.sparkContext.broadcast(Probe(shards, first, lanes, alphabet))
        positives.append(stored(_positives(known, probe), "spelling-positives"))
        probe.unpersist()
    if not positives:
        return known.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    found = positives[0]
    for more in positives[1:]:
        found = found.unionAll(more)
    other = known.select(F.col("word").alias("near"), F.col("n").alias("near_n"), F.col("key").alias("edit"))
    pairs = found.join(other, "edit").join(known, "key").where(F.levenshtein("word", "near", 1) == 1)
    ways = F.array(
        *[F.struct(*[F.col(c).alias(a) for c, a in zip(way, ("word", "n", "near", "near_n"), strict=True)])
          for way in (("word", "n", "near", "near_n"), ("near", "near_n", "word", "n"))]
    )
    return pairs.select(F.inline(ways))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, by steps that double."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = reached.join(onward, "root", "left")
        reached = stored(
            joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots"
        )
        if reached.where("moved").isEmpty():
            return reached.select("word", "root")


def variants(words: DataFrame, times: int = TIMES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of (word, n).

    The form of a word is its most frequent near word (ties: smaller code points), where that is `times` as frequent.
    """
    words = stored(words, "spelling-vocabulary")
    best = (
        near_words(words, filter_bytes)
        .groupBy("word", "n")
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    )
    told = F.col("best")["less"] * -1 >= F.col("n") * times
    best = stored(
        best.select(
            "word", "n_near", F.when(told, F.col("best")["near"]).alias("form"), F.when(told, -F.col("best")["less"]).alias("form_n")
        ),
        "spelling-best",
    )
    roots = _roots(best.where(F.col("form").isNotNull()))
    out = words.join(best, "word", "left").join(roots, "word", "left")
    return out.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def variant_groups(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """`variants` of the vocabulary of whole texts."""
    return variants(vocabulary(docs, text, id_column))


