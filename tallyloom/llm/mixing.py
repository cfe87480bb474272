"""Mix sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a fixed shuffled order, passed up to `passes` times.  A copy of a document
finishes at virtual time (words of its source up to and with it) / (the source's target); all copies are sorted
globally by that time and the mix ends where their words reach the total budget.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import stored

WEIGHTS = (5, 2, 1)
PASSES = 3
#: Rows, about, that a task orders at a time: a slice of a source, and the part of the global order where the budget ends.
SLICE_ROWS = 100_000
#: A source has 2**12 slices by the first bits of the key, each of up to 2**12 finer ones, as its rows ask for it.
SLICE_BITS = 12
#: Most parts that the global order is cut into at a time; the one where the budget ends is cut again while it is large.
PARTS = 4_096


def words_of(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """(queue, source, source_size) with `place` (from 0, by code point, null last), `target` and `budget` added.

    All sizes are shared by weight; a source gets at most `passes` times its size and the excess is shared again.  With
    sources filled in order of most / weight, each source sees what is left per weight left; the share per weight that
    ends the sharing is the largest of these.  One row per source, sorted as one small table.
    """
    ranked = sizes.withColumn("place", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(float(passes)))
    order = W.orderBy(F.col("most") / F.col("weight"), "place")
    everything = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    earlier, later = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    ranked = ranked.withColumn("budget", F.sum("source_size").over(everything))
    left = F.col("budget") - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    ranked = ranked.withColumn("level", left / F.sum("weight").over(later))
    ranked = ranked.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("most"), F.col("level") * F.col("weight"))
    return ranked.select("queue", "source", "source_size", "place", target.alias("target"), "budget")


def _rows(df: DataFrame, text: str, source: str, id_column: str, keep: Sequence[str]) -> DataFrame:
    own, body = F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`")
    own = F.coalesce(F.concat(F.length(own), F.lit(":"), own), F.lit("-"))
    key = F.md5(F.concat(own, F.coalesce(F.concat(F.lit("+"), body), F.lit("-"))))
    name = F.col(f"`{source}`").cast("string")
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        F.when(name.isNull(), "-").otherwise(F.concat(F.lit("+"), name)).alias("queue"),
        words_of(body).alias("size"),
        F.unhex(key).alias("key"),
    )


def _sliced(rows: DataFrame, bits: int) -> DataFrame:
    """Adds `slice`, the first SLICE_BITS bits of the key, and `fine`, the next `bits`; of the first 24 together."""
    head, rest = F.conv(F.hex(F.substring("key", 1, 3)), 16, 10).cast("int"), 24 - SLICE_BITS
    fine = F.shiftright(head.bitwiseAND(F.lit((1 << rest) - 1)), rest - bits)
    return rows.withColumn("slice", F.shiftright(head, rest)).withColumn("fine", fine)


def _befores(slices: DataFrame, bits: int) -> DataFrame:
    """(queue, slice, fine, before): the sizes that come before each slice in its queue.

    No window is over more rows than a queue has slices, or a slice finer ones; where there are none (bits is 0), one
    window does.
    """

    def earlier(order: str, *within: str) -> Column:
        window = W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("slice_size").over(window), F.lit(0))

    if not bits:
        return slices.withColumn("before", earlier("slice", "queue")).drop("slice_size")
    coarse = slices.groupBy("queue", "slice").agg(F.sum("slice_size").alias("slice_size"))
    coarse = coarse.withColumn("whole", earlier("slice", "queue")).drop("slice_size")
    inside = slices.withColumn("part", earlier("fine", "queue", "slice")).join(coarse, ["queue", "slice"])
    return inside.select("queue", "slice", "fine", (F.col("whole") + F.col("part")).alias("before"))


def _finish(turn: Column) -> Column:
    return (turn * F.col("source_size") + F.col("reach")) / F.col("target")


def _spot(turn: Column) -> Column:
    """Place of a copy in the global order."""
    return F.struct(_finish(turn).alias("finish"), F.col("place"), F.col("key"), turn.alias("turn"))


def mix(
    df: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES, text: str = "text", source: str = "source",
    id_column: str = "doc_id", keep: Sequence[str] | None = None, slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Every row's `keep` columns (all if None) and size, source_size, target, turns (times the mix takes it) and taken
    (the words that makes).  A kept column with one of these names gives way.

    The order of a source is that of md5 of the id, behind its length, and the text, nulls marked, so reruns agree,
    whatever the partitions; rows equal in id, text and source are interchangeable.  A null text has size 0; rows of size 0 are never taken; a null source is a source
    of its own, last in order; an empty table gives no rows.
    """
    added = ("size", "source_size", "target", "turns", "taken")
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in added]
    small = stored(_rows(df, text, source, id_column, [id_column]).drop("kept"), "mix-documents")
    wanted = (small.count() // slice_rows).bit_length()  # bits that leave about slice_rows rows of one source together
    bits = min(24 - SLICE_BITS, max(0, wanted - SLICE_BITS))
    slices = _sliced(small, bits).groupBy("queue", "slice", "fine").agg(F.sum("size").alias("slice_size"))
    sizes = slices.groupBy("queue").agg(F.sum("slice_size").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(F.col("queue") != "-", F.substring("queue", 2, 1 << 30)))
    goals = targets(sizes, weights, passes)
    starts = stored(_befores(slices, bits).join(goals.drop("source"), "queue"), "mix-queues")

    def queued(rows: DataFrame) -> DataFrame:
        within = W.partitionBy("queue", "slice", "fine").orderBy("key").rowsBetween(W.unboundedPreceding, 0)
        reached = _sliced(rows, bits).withColumn("own", F.sum("size").over(within)).join(starts, ["queue", "slice", "fine"])
        return reached.withColumn("reach", F.col("before") + F.col("own"))

    turns = F.sequence(F.lit(0), F.lit(passes - 1))
    copies = queued(small).where(F.col("size") > 0).withColumn("turn", F.explode(turns))
    copies = copies.select(_spot(F.col("turn")).alias("spot"), "size", "budget")
    end = _cut(copies, slice_rows)
    rows = _rows(df, text, source, id_column, kept) if kept else small
    placed = queued(rows).withColumn("end", end.scalar())
    taken = F.size(F.filter(turns, lambda t: _spot(t) <= F.col("end")))
    placed = placed.withColumn("turns", F.when(F.col("size") > 0, F.coalesce(taken, F.lit(0))).otherwise(0))
    return placed.select(
        *([F.col("kept")[c].alias(c) for c in kept]),
        "size", "source_size", "target", "turns", (F.col("turns") * F.col("size")).alias("taken"),
    )


def _cut(copies: DataFrame, slice_rows: int, most_parts: int = PARTS) -> DataFrame:
    """One row: the last spot of the global order within the budget; null if there is none.

    The order is cut into ranges whose words are summed; the range where the budget ends is cut again, until one task can
    order it.  The driver sees one row for each time.
    """
    rows = stored(copies, "mix-copies")
    count, before, ends = rows.count(), 0, []
    while count > slice_rows:
        parts = min(most_parts, max(16, count // slice_rows + 1))
        ranged = rows.repartitionByRange(parts, "spot").withColumn("part", F.spark_partition_id())
        ranged = stored(ranged, "mix-order")
        totals = ranged.groupBy("part").agg(
            F.sum("size").alias("words"), F.max("budget").alias("budget"), F.max("spot").alias("last"), F.count("*").alias("n")
        )
        until = F.sum("words").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, 0))  # one row per part
        totals = stored(totals.withColumn("until", F.lit(before) + until), "mix-parts")
        ends.append(totals.where(F.col("until") <= F.col("budget")).select(F.max("last").alias("end")))
        split = totals.where((F.col("until") > F.col("budget")) & (F.col("until") - F.col("words") < F.col("budget"))).first()
        if split is None:
            return stored(reduce(DataFrame.unionByName, ends).agg(F.max("end").alias("end")), "mix-end")
        rows = ranged.where(F.col("part") == split["part"]).drop("part")
        before = split["until"] - split["words"]
        if split["n"] == count:  # one range, which can't be cut
            break
        count = split["n"]
    until = F.lit(before) + F.sum("size").over(W.orderBy("spot").rowsBetween(W.unboundedPreceding, 0))
    ends.append(rows.withColumn("until", until).where(F.col("until") <= F.col("budget")).select(F.max("spot").alias("end")))
    return stored(reduce(DataFrame.unionByName, ends).agg(F.max("end").alias("end")), "mix-end")


def mixed_rows(df: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES, **columns) -> DataFrame:
    """The rows of the mix itself: each row as often as the mix takes it, with the columns of `df`."""
    names = df.columns
    renamed = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    at = {k: f"c{names.index(columns.get(k, v))}" for k, v in (("text", "text"), ("source", "source"), ("id_column", "doc_id"))}
    rows = mix(renamed, weights, passes, **at).where(F.col("turns") > 0)
    rows = rows.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("turns"))))
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
