"""Rows that meet nothing are not shuffled to learn it."""

from __future__ import annotations

from tallyloom.llm import neardup
from tallyloom.llm.frames import sifted


def test_sieve_loses_nothing(spark):
    rows = spark.range(20_000).selectExpr("id", "if(id % 7 = 0, null, id % 100) AS other", "'x' AS text")
    few = rows.where("id % 50 = 0").select("id", "other")
    left = sifted(rows, few, ["id", "other"])
    assert left.columns == rows.columns
    found = [r["id"] for r in left.collect()]
    assert {*range(0, 20_000, 50)} <= {*found} and len(found) < 500 and len({*found}) == len(found)
    assert sifted(rows, few, ["id", "other"], word_bits=0).count() >= 400  # a full sieve lets all through, once
    assert sifted(rows, few.where("false"), ["id", "other"]).count() == 0
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_texts_are_banded_once(spark, monkeypatch):
    """A text's bands are made rows once, however often it comes; its copies stay in its class."""
    seen = {}
    kept = neardup.stored
    monkeypatch.setattr(neardup, "stored", lambda df, name: seen.setdefault(name, kept(df, name)) if name == "neardup-bands" else kept(df, name))
    words = " ".join(f"word{i}" for i in range(60))
    docs = [(n, words) for n in range(6)] + [(6, words + " more"), (7, "quite another text of some words here"), (8, None), (None, words)]
    found = neardup.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert seen["neardup-bands"].count() == 3
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in found if r["doc_id"] is not None) == [
        (n, 0, 8) for n in range(7)
    ] + [(7, 7, 1), (8, 8, 1)]
