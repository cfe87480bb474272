"""Divergence of sources: how far the smoothed term shares of two sources of a language lie apart, and by which terms.

Every language keeps the terms that stand in enough of its documents, numbered by falling frequency.  A source is stored
as count-level bitmaps: for each 64 terms and each count that occurs there, the terms with exactly that count.  For two
sources, AND and a population count of two levels give the number of terms in their joint cell, and all terms of a cell
have one difference of shares; the terms that a source lacks are the complement of its levels.  So the distance of a pair
is a sum over cells, exact in whole numbers, and no row is made for each term of each pair.

Pairs are worked on in blocks of sources over slabs of terms, each one task's small group: a hot source or language has
many slabs, and sums of slabs are combined before they are shuffled.

Null texts, languages and sources count as empty strings, which are a text without terms and a language and source of
their own.  Repeated rows and rows without id are documents like others; ties of values go by the bytes of the item; an
empty table gives an empty result.  Long texts are counted whole.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbering import numbered
from tallyloom.llm.frames import find_package, small_batches
from tallyloom.session import stored

#: What a term is, in how many documents of a language it must stand, and the smoothed share.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCUMENTS, SCALE, SMOOTH, TOP = 30, 1_000_000_000, 5, 50
#: Terms of a slab (in chunks of 64), and sources of a block.
SLAB, BLOCK = 16, 64
#: Different terms that a task counts before it hands them on.
_HELD = 200_000


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences of terms and documents that hold them; '' stands for null.

    Every (lang, source) that occurs also has a row of the empty term with its number of documents, so that sources
    without terms are told.  Tasks add up what they read before it is shuffled.
    """
    columns = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(f"_{i}") for i, c in enumerate((lang, source, text))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(TERM).findall
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def told():
            for (a, b), (times, inside) in held.items():
                terms = list(times)
                columns = [[a] * len(terms), [b] * len(terms), terms, list(times.values()), [inside[t] for t in terms]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for a, b, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                times, inside = held.setdefault((a, b), (Counter(), Counter()))
                found = Counter(find(body.encode().lower().decode()))  # bytes.lower() changes A-Z alone
                found[""] += 1
                size -= len(times)
                times.update(found)
                inside.update(found.keys())
                size += len(times)
                if size > _HELD:
                    yield from told()
                    held.clear()
                    size = 0
        yield from told()

    find_package(docs)
    small_batches(docs)
    counted = docs.select(*columns).mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a term in units of 1 / SCALE, by whole numbers of any size."""
    wide = "decimal(20,0)"
    above = F.lit(SCALE).cast("decimal(10,0)") * (count.cast(wide) + F.lit(SMOOTH).cast("decimal(1,0)"))
    below = total.cast(wide) + F.lit(SMOOTH).cast("decimal(1,0)") * terms.cast("decimal(18,0)")
    return F.lit(1) + F.call_function("div", above, below)


class Audit:
    """Stored counts, kept terms and sources of a corpus, from which both parts of the audit are made."""

    def __init__(self, docs: DataFrame, least: int = LEAST_DOCUMENTS, **columns: str):
        self.counts = stored(term_counts(docs, **columns), "divergence-counts")
        words = self.counts.where(F.col("term") != "")
        terms = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        terms = terms.withColumn("_rare", -F.col("lang_n"))
        self.terms = stored(numbered(terms, ["lang", "_rare", "term"]).drop("_rare"), "divergence-terms")
        langs = self.terms.groupBy("lang").agg(
            F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"), F.min("number").alias("first")
        )
        named = words.select("lang", "source", "term", "n").join(self.terms.drop("docs"), ["lang", "term"])
        self.kept = stored(named, "divergence-kept")
        totals = self.kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        sources = numbered(self.counts.where(F.col("term") == "").select("lang", "source"), ["lang", "source"], "place")
        none = F.lit(0).cast("long")
        sources = stored(sources.withColumn("block", F.floor(F.col("place") / BLOCK)), "divergence-sources")
        blocks = sources.groupBy("lang").agg(F.min("block").alias("low"), F.max("block").alias("high"))
        sources = sources.join(blocks, "lang").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        sources = sources.fillna(0, ["total", "kept", "lang_total", "first"])
        self.sources = stored(sources.withColumn("p0", _share_or(none, "total", none)), "divergence-sources")

    def levels(self) -> DataFrame:
        """(lang, source, chunk, n, bits): for each 64 terms, those that a source has exactly `n` times, as bits."""
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % 64).cast("int"))
        return self.kept.groupBy("lang", "source", F.floor(F.col("number") / 64).alias("chunk"), "n").agg(F.bit_or(bit).alias("bits"))

    def distances(self) -> DataFrame:
        """(a, b, value): the summed differences of shares of each two sources of a language, by their places, a < b."""
        own = self.sources.select("lang", "source", "place", "block", "low", "high", "total", "kept")
        levels = self.levels().join(own, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
        sides = ["lang", "block", "low", "high", "place"]
        levels = levels.select(*sides, "chunk", "p", "bits", F.lit(0).cast("long").alias("first"), F.col("kept"))
        last = F.floor((F.col("first") + F.greatest(F.col("kept"), F.lit(1)) - 1) / (64 * SLAB))
        slabs = F.sequence(F.floor(F.col("first") / (64 * SLAB)), last)
        heads = self.sources.select(
            *sides, F.explode(F.transform(slabs, lambda x: x * SLAB)).alias("chunk"), F.col("p0").alias("p"),
            F.lit(None).cast("long").alias("bits"), "first", "kept",
        )
        rows = levels.unionByName(heads).withColumn("slab", F.floor(F.col("chunk") / SLAB))
        rows = rows.withColumn("other", F.explode(F.sequence("low", "high")))
        rows = rows.select(
            "lang", "slab", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
            "block", "place", "chunk", "p", "bits", "first", "kept",
        )
        find_package(rows)
        sums = rows.groupBy("lang", "slab", "left", "right").applyInArrow(_cells, "a long, b long, value long")
        return sums.groupBy("a", "b").agg(F.sum("value").alias("value"))


def _share_or(count: Column, total: str, empty: Column) -> Column:
    """A source's share of a count; `empty` where its language keeps no term."""
    return F.when(F.col("kept") > 0, share(count, F.col(total), F.col("kept"))).otherwise(empty)


def _cells(table: pa.Table) -> pa.Table:
    """Sums over the joint cells of each pair of sources of two blocks, for one slab of terms."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    place, chunk, p, block = (table.column(c).to_numpy() for c in ("place", "chunk", "p", "block"))
    head = np.asarray(table.column("bits").is_null())
    bits = table.column("bits").fill_null(0).to_numpy().view(np.uint64)
    first, kept = (int(table.column(c).to_numpy()[head][0]) for c in ("first", "kept"))
    places, at = np.unique(place[head], return_index=True)
    zeros, sides = p[head][at], block[head][at]
    index = np.searchsorted(places, place)
    values = np.zeros((len(places), len(places)), np.int64)
    slab = int(chunk[head][0]) // SLAB
    for c in range(slab * SLAB, slab * SLAB + SLAB):
        # The terms of this language among the 64 of the chunk.
        low, high = max(first, c * 64) - c * 64, min(first + kept, c * 64 + 64) - c * 64
        if high <= low:
            continue
        mask = np.uint64(((1 << high) - 1) & ~((1 << low) - 1))
        here = np.flatnonzero(~head & (chunk == c))
        said = np.zeros(len(places), np.uint64)
        np.bitwise_or.at(said, index[here], bits[here])
        who = np.concatenate([index[here], np.arange(len(places))])
        level = np.concatenate([bits[here], mask & ~said])
        shares = np.concatenate([p[here], zeros])
        order = np.argsort(who, kind="stable")
        who, level, shares = who[order], level[order], shares[order]
        starts = np.searchsorted(who, np.arange(len(places)))
        ends = np.append(starts[1:], len(who))
        for a in np.flatnonzero(sides == left).tolist():
            own = slice(starts[a], ends[a])
            cells = np.bitwise_count(level[own, None] & level[None, :]).astype(np.int64)
            cells *= np.abs(shares[own, None] - shares[None, :])
            values[a] += np.add.reduceat(cells.sum(axis=0), starts)
    which = (sides == left)[:, None] & (sides == right)[None, :] & (places[:, None] < places[None, :])
    a, b = np.nonzero(which)
    return pa.table({"a": pa.array(places[a], pa.int64()), "b": pa.array(places[b], pa.int64()), "value": values[a, b]})


def pairs(audit: Audit) -> DataFrame:
    """(lang, source, part, item, value, rank) of every other source of each source's language."""
    both = audit.distances().select(
        F.inline(F.array(F.struct("a", "b", "value"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "value")))
    )
    one = audit.sources.select(F.col("place").alias("a"), "lang", "source")
    other = audit.sources.select(F.col("place").alias("b"), F.col("source").alias("item"))
    return _ranked(both.join(one, "a").join(other, "b"), "pair")


def terms(audit: Audit, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) of the terms whose share in a source most exceeds that in its language."""
    own = audit.sources.select("lang", "source", "total", "kept", "lang_total")
    p, q = share(F.col("n"), F.col("total"), F.col("kept")), share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    more = audit.kept.join(own, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), (p - q).alias("value"))
    return _ranked(more.where(F.col("value") > 0), "term").where(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, **columns: str) -> DataFrame:
    """Both parts for every source of every language."""
    known = Audit(docs, least, **columns)
    return pairs(known).unionByName(terms(known, top))
