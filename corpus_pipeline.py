"""A corpus pipeline: language, near copies, personal data, mixing, tokens.

Each stage takes (spark, docs, folder) and returns the documents it keeps, with the columns of `documents`; the last
returns one row of token ids per document of the mix.  Each stage's result is written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, language, mixing, neardup, pii
from tallyloom.llm.queries import language_model
from tallyloom.session import stored


def _named_apart(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with columns that no operator's result can be named like, and the name of the text among them."""
    apart = docs.toDF(*[f"_doc{i}" for i in range(len(docs.columns))])
    return apart, apart.columns[docs.columns.index("text")]


def identified(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep documents whose language can be told: those without any letter go, and they alone.

    Where no row teaches a language, documents with a letter stay all the same.  Null and empty texts have none; rows that
    repeat are judged alike; an empty table stays empty; all columns stay as they are, whatever their names.
    """
    model = language_model(docs)
    apart, text = _named_apart(docs)
    if not model.languages:
        return apart.where(F.col(text).rlike(r"\p{L}")).toDF(*docs.columns)
    known = language.identify(apart, model, text=text)
    return known.where(F.col("lang_pred") != language.UNKNOWN).select(apart.columns).toDF(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keep one document of each group of near copies, that of the smallest id, once if it repeats.

    Null and empty texts stay, and all columns as they are; an empty table stays empty.
    """
    return neardup.deduplicate(docs)


def sanitised(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Mask personal data and what discloses it in every text; `n_chars`, where there is one, follows.

    Null texts stay null, empty ones empty; every row stays, repeated or not, with its other columns as they are.
    """
    apart, text = _named_apart(docs)
    safe = pii.sanitise(apart, text=text).select(apart.columns).toDF(*docs.columns)
    return safe.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else safe


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix of the sources by weight; a document stands in it as often as it is taken.

    Documents without a word are not taken; an empty table stays empty; all columns stay as they are.
    """
    return mixing.mixed_rows(docs)


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document, and proof that they decode to its text; a null text counts as empty.

    One row for each row of the mix; other columns are not read.
    """
    path, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    coded = bpe.encode(docs, path, pattern, offsets=False, keep=["doc_id", "text"])
    decoded = bpe.decode(coded, path, pattern, keep=["doc_id", "text", "ids"])
    right = F.col("decoded").eqNullSafe(F.coalesce("text", F.lit("")))
    return decoded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), right.alias("round_trip"))


STAGES = [
    ("language_id", identified),
    ("near_duplicates", deduplicated),
    ("pii", sanitised),
    ("mixing", mixed),
    ("byte_bpe", encoded),
]

#: The stages' models and signatures have no SQL form; tests hold the pipeline against its operators one by one.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, folder)
