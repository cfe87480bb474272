"""Bounded samples of labelled rows, as features on the driver, for models that are small and trained there."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import map_columns
from tallyloom.llm.words import Grams
from tallyloom.session import stored

_PARTS = 1 << 20


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """About `most` rows of (id, text, label) at the outside, one per id, chosen by hash of the id; all if there are no more.

    The share is set by the count of distinct ids, so that repeated rows can't enlarge the sample.
    """
    ids = rows.agg(F.approx_count_distinct("id", 0.02).alias("n")).first()["n"]
    share = min(_PARTS, int(_PARTS * most / max(1, ids)))
    chosen = rows.where(F.pmod(F.xxhash64("id", F.lit(20)), F.lit(_PARTS)) < share)
    return chosen.dropDuplicates(["id"])


def sampled_by_label(rows: DataFrame, most: int, least: int) -> DataFrame:
    """Rows of (id, text, label), one per id: of each label the larger of `least` and its share of `most`, about, chosen by
    hash of the id; all of a label that has no more.

    Together about 2 x `most` at the outside: the least shrinks where there are many labels, to about one row each.  Shares are
    set by counts of distinct ids, one row per label; labels of one id beyond the least don't count.
    """
    draw = F.pmod(F.xxhash64("id", F.lit(20)), F.lit(_PARTS))
    counts = rows.groupBy("label").agg(F.approx_count_distinct("id", 0.02).alias("_n"), F.min(draw).alias("_first"))
    counts = stored(counts, "label-counts")
    seen = counts.agg(F.sum("_n").alias("total"), F.count("*").alias("labels")).first()
    # Twice the least where there is more: a draw by hash varies, and must not leave a label with few rows.
    least = min(2 * least, max(1, most // max(1, seen["labels"])))
    wanted = F.greatest(F.floor(F.col("_n") * most / max(1, seen["total"] or 0)), F.lit(least))
    share = F.least(F.lit(_PARTS), F.ceil(wanted * _PARTS / F.greatest("_n", F.lit(1))))
    share = F.greatest(share, F.col("_first") + 1)  # no label is left without a row
    chosen = rows.join(counts.select("label", share.alias("_share")), "label").where(draw < F.col("_share"))
    first = chosen.groupBy("id").agg(F.min(F.struct("label", "text")).alias("_row"))
    return first.select("id", F.col("_row")["text"].alias("text"), F.col("_row")["label"].alias("label"))


def gram_features(rows: DataFrame, grams: Grams) -> tuple[list[tuple[np.ndarray, np.ndarray]], list]:
    """((buckets, counts) of each row's text, labels), in order of id."""

    def compute(texts):
        found = [grams.counts(t) for t in texts]
        return [b.tobytes() for b, _ in found], [c.tobytes() for _, c in found]

    told = map_columns(rows, "buckets binary, counts binary", compute, ["text"], ["id", "label"])
    told = sorted(told.collect(), key=lambda r: r["id"])
    return [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32)) for r in told], [r["label"] for r in told]


def labelled(
    docs: DataFrame, labels: DataFrame, train_on: Column, label: str, text: str, id_column: str, most: int
) -> DataFrame:
    """About `most` rows of (id, text, label): documents with a 0/1 label where `train_on` (of the labels' columns) holds.

    The sample is drawn from the labels, so that only its ids, at most about `most`, meet the documents; ids that
    repeat among labels or documents count once.
    """
    marks = labels.where(train_on & F.col(f"`{label}`").isin(0, 1) & F.col(f"`{id_column}`").isNotNull())
    marks = marks.groupBy(F.col(f"`{id_column}`").alias("id")).agg(F.min(f"`{label}`").cast("int").alias("label"))
    share = min(_PARTS, int(_PARTS * most / max(1, marks.count())))
    chosen = marks.where(F.pmod(F.xxhash64("id", F.lit(20)), F.lit(_PARTS)) < share)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text")).where(F.col("text").isNotNull())
    return rows.join(F.broadcast(chosen), "id").dropDuplicates(["id"])
