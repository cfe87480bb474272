"""The pipeline's stages against their own rules, and every registered query over the smallest folder."""

from __future__ import annotations

from collections import Counter

import __spark_entry__ as entry_point
import compare
import corpus_pipeline
import pytest
import tiktoken  # noqa: F401
from tallyloom.llm import neardup, pii
from tallyloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents that each stage left, by name."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    left = {"documents": docs.cache()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        left[name] = docs
    return left


def test_stages_keep_the_columns_of_documents(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns
        assert stages[name].dtypes == stages["documents"].dtypes


def test_language_keeps_documents_with_letters(stages):
    before, after = stages["documents"], stages["language_id"]
    lettered = {r["doc_id"] for r in before.where(r"text RLIKE '\\p{L}'").select("doc_id").collect()}
    assert {r["doc_id"] for r in after.collect()} == lettered


def test_one_document_of_each_group_stays(stages):
    before, after = stages["language_id"], stages["near_duplicates"]
    told = neardup.classes(before).collect()
    assert sorted(r["doc_id"] for r in after.collect()) == sorted({r["class_id"] for r in told})


def test_no_personal_data_is_left(stages):
    found = pii.digest(stages["pii"]).where("n_email + n_ip + n_card + n_phone > 0")
    assert stages["pii"].count() == stages["near_duplicates"].count() and found.count() == 0


def test_every_copy_of_the_mix_is_encoded(stages):
    mixed, encoded = stages["mixing"], stages["byte_bpe"].collect()
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter(r["doc_id"] for r in encoded)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_run_gives_the_last_stage(spark, stages):
    rows = entry_point.queries()["pipeline"](spark, FOLDER)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows.collect()) == Counter(
        (r["doc_id"], tuple(r["ids"])) for r in stages["byte_bpe"].collect()
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert name in entry_point.queries()
    rows = compare.spark_rows(QUERIES[name](spark, FOLDER))
    assert rows[1]
    if name in ORACLES:
        assert compare.difference(rows, compare.sql_rows(compare.connect(FOLDER), ORACLES[name])) is None
