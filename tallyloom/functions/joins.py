"""Joins that split hot keys themselves.

Adaptive execution splits a hot key only where both sides of a join are plain shuffles, so not where one side is an
aggregate by that key.  `split_join` needs no such shape: it deals the rows of each hot key over as many parts as its
count asks for, and repeats the other side's rows of that key once for each part.  Other keys have one part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

HOT_ROWS = 1_000_000
#: Most hot keys that are sent to every task; more are joined like any table.
SENT_KEYS = 100_000


def key_counts(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each key, as `_n`."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n"))


def split_join(
    many: DataFrame,
    few: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    counts: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """`many.join(few, keys, how)` for inner, left, left_semi and left_anti joins, with keys of more than `hot_rows` rows
    of `many` split into parts of about that many.

    `few` should hold few rows for each key: those of a hot key are repeated for each of its parts.  `counts` is what
    `key_counts` gives for `many` (or more), where it is known; else `many` is counted, and should be a stored table.  A
    row's part is a hash of its columns, so it is the same when a lost task runs again; equal rows go to one part.  Null
    keys match nothing, as in the plain join.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not split: {how}")
    keys = list(keys)
    counts = key_counts(many, keys) if counts is None else counts
    parts = F.ceil(F.col("_n") / hot_rows).cast("int").alias("_parts")
    hot = stored(counts.where(F.col("_n") > hot_rows).select(*keys, parts), "hot-keys")
    found = hot.limit(SENT_KEYS + 1).count()
    if not found:
        return many.join(few, keys, how)
    sent = F.broadcast(hot) if found <= SENT_KEYS else hot
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in many.columns]), F.coalesce("_parts", F.lit(1))).cast("int")
    dealt = many.join(sent, keys, "left").withColumn("_part", part).drop("_parts")
    each = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    repeated = few.join(sent, keys, "left").withColumn("_part", each).drop("_parts")
    return dealt.join(repeated, [*keys, "_part"], how).drop("_part")
