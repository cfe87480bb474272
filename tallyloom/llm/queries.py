"""One query per operator, over whole tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, divergence, hnsw, kdtree, language, mixing, neardup, pii, quality, quality_rules, shards, spelling, substring, toxicity
from tallyloom.llm.frames import remainder
from tallyloom.llm.oracles import ORACLES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query
def op1_pii(spark, folder):
    return pii.digest(documents(spark, folder))


@query
def op2_byte_bpe(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.round_trip(documents(spark, folder), path, public_tokenizers.PATTERN, keep=["doc_id"])


@query
def op3_repeated_passages(spark, folder):
    return substring.deduplicate(documents(spark, folder)).select("doc_id", "text", "removed")


def held_out(docs: DataFrame, modulus: int, left: int) -> DataFrame:
    """doc_id, text and whether the id's crc32 leaves the remainder of the held-out documents."""
    held = F.coalesce(remainder("doc_id", modulus) == left, F.lit(False))
    return docs.select("doc_id", "text", held.alias("held_out"))


@query
def op4_toxicity(spark, folder):
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels, remainder("doc_id", 5) != 0)
    return toxicity.score(held_out(docs, 5, 0), model, keep=["doc_id", "held_out"])


def language_model(docs: DataFrame) -> language.LanguageModel:
    """Learned from every labelled document but those whose crc32 mod 4 is 2."""
    return language.fit(docs, F.coalesce(remainder("doc_id", 4) != 2, F.lit(False)))


@query
def op5_language(spark, folder):
    docs = documents(spark, folder)
    return language.identify(held_out(docs, 4, 2), language_model(docs), keep=["doc_id", "held_out"])


@query
def op6_quality(spark, folder):
    docs, labels = documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels, remainder("doc_id", 3) != 1)
    return quality.score(held_out(docs, 3, 1), model, keep=["doc_id", "held_out"])


@query
def op7_near_copies(spark, folder):
    return neardup.classes(documents(spark, folder)).select("doc_id", "class_id", "class_size", "keep")


def embeddings(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All (id, vector), and those whose id is divisible by 20."""
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return rows, rows.where("id % 20 = 0")


@query
def op8_exact_top_k(spark, folder):
    """Components become floor(64 x), so that scores are whole numbers."""
    rows, queries = (
        x.select("id", "vector").where(shards.finite(F.col("vector"))).withColumn(
            "vector", F.transform("vector", lambda v: F.floor(v.cast("double") * 64).cast("double"))
        )
        for x in embeddings(spark, folder)
    )
    return kdtree.top_k(rows, queries).withColumn("score", F.col("score").cast("long"))


@query
def op9_nearest(spark, folder):
    return hnsw.nearest(*embeddings(spark, folder))


@query
def op10_mixing(spark, folder):
    docs = documents(spark, folder)
    return mixing.mix(docs, keep=["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")


@query
def op11_quality_rules(spark, folder):
    judged = quality_rules.judge(documents(spark, folder), keep=["doc_id"])
    return judged.select("doc_id", *quality_rules.BASE_COUNTS, "base_failed", "kept")


@query
def op12_spelling(spark, folder):
    return spelling.variant_groups(documents(spark, folder))


@query
def op13_divergence(spark, folder):
    return divergence.audit(documents(spark, folder))


__all__ = ("ORACLES", "QUERIES")
