"""Repeated passages: runs of consecutive sentences that occur before lose their later copies.

From each sentence on, and up to each sentence, the shortest run of consecutive sentences that holds `least_words` words
is hashed (128 bits over its sentences' lower-case words), so a passage of that length is covered from end to end wherever it stands.
All runs meet by hash; every occurrence but the first, by document and place, marks its sentences for removal.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.frames import map_columns
from tallyloom.session import stored

LEAST_WORDS = 25
#: A sentence with the white space behind it: up to a full stop, question or exclamation mark before white space, or
#: the end of a line.
_SENTENCE = re.compile(r"[^\n.!?。！？]*(?:[.!?。！？]+(?!\s)[^\n.!?。！？]*)*(?:[.!?。！？]+\s*|\n\s*|$)")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> list[str]:
    """The sentences of a text; joined they are the text."""
    return [m for m in _SENTENCE.findall(text) if m]


def runs(text: str, least_words: int) -> list[tuple[bytes, int, int]]:
    """(hash, first sentence, last sentence) of each distinct run of a text, by place."""
    words = [_WORD.findall(s.lower()) for s in sentences(text)]
    found, n = set(), len(words)
    end, total = 0, 0
    for start in range(n):  # the shortest run from each sentence on
        while end < n and total < least_words:
            total += len(words[end])
            end += 1
        if total < least_words:
            break
        found.add((start, end - 1))
        total -= len(words[start])
    start, total = n - 1, 0
    for last in range(n - 1, -1, -1):  # and up to each sentence
        while start >= 0 and total < least_words:
            total += len(words[start])
            start -= 1
        if total < least_words:
            break
        found.add((start + 1, last))
        total -= len(words[last])
    own = [hashlib.blake2b(" ".join(x).encode(), digest_size=16).digest() for x in words]
    return [(hashlib.blake2b(b"".join(own[s : e + 1]), digest_size=16).digest(), s, e) for s, e in sorted(found)]


def _without(text: str | None, spans: list[list[int]] | None) -> tuple[str | None, int]:
    """A text without the sentences of the spans, and how many went."""
    if text is None or not spans:
        return text, 0
    gone = {i for first, last in spans for i in range(first, last + 1)}
    kept = [s for i, s in enumerate(sentences(text)) if i not in gone]
    return "".join(kept), len(gone)


def deduplicate(df: DataFrame, text: str = "text", id_column: str = "doc_id", least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows with `text` freed of repeated passages, and `removed`, the number of sentences that went.

    The first occurrence, which stays, is that of the smallest document id (null last; then by hash of the text) and in
    it the earliest.  Rows of one id and text are one document: they lose the same.  Null and empty texts stay as they
    are; a text all of whose sentences repeat becomes empty.  A column named `removed` gives way.
    """
    names = [c for c in df.columns if c.lower() != "removed"]
    body, key = f"c{names.index(text)}", f"c{names.index(id_column)}"
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]).withColumn("_mark", F.xxhash64(body))
    texts = rows.select(F.col(key).alias("id"), F.col("_mark").alias("mark"), F.col(body).alias("_text"))

    def compute(batch):
        return [[[{"hash": h, "first": s, "last": e} for h, s, e in runs(t, least_words)] for t in batch]]

    schema = "runs array<struct<hash:binary,first:int,last:int>>"
    told = map_columns(texts.where(F.length("_text") > 0), schema, compute, ["_text"], ["id", "mark"])
    told = stored(told.select("id", "mark", F.explode("runs").alias("run")).select("run.*", "id", "mark"), "substring-runs")
    # Aggregates are stored before they are joined: with plain shuffles on both sides, a very common run can be split.
    known = stored(told.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "substring-known")
    spot = F.struct(F.col("id").isNull().alias("nameless"), "id", "mark", "first", "last")
    again = stored(told.join(known, "hash").select("hash", spot.alias("spot")), "substring-repeated")
    firsts = stored(again.groupBy("hash").agg(F.min("spot").alias("earliest")), "substring-firsts")
    later = again.join(firsts, "hash").where("spot != earliest").select("spot.*").distinct()
    gone = later.groupBy("id", "mark").agg(F.collect_set(F.array("first", "last")).alias("_gone"))  # of one document
    rows = rows.join(gone, rows[key].eqNullSafe(gone["id"]) & (rows["_mark"] == gone["mark"]), "left").select(
        *[rows[f"c{i}"] for i in range(len(names))], "_gone"
    )

    def cut(batch, spans):
        cleaned = [_without(t, s) for t, s in zip(batch, spans)]
        return [t for t, _ in cleaned], [n for _, n in cleaned]

    kept = [f"c{i}" for i in range(len(names)) if f"c{i}" != body]
    out = map_columns(rows, "_clean string, removed int", cut, [body, "_gone"], kept)
    return out.select(*[F.col("_clean" if f"c{i}" == body else f"c{i}").alias(c) for i, c in enumerate(names)], "removed")
