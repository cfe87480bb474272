"""Customer reviews: from delimited text or from document and label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.columns import strip
from tallyloom.sources.order_lines import read_text_table

REVIEW_COLUMNS = {
    "review_text": ("review", "text", "comment"),
    "sentiment": ("sentiment",),
}
NUMERIC_COLUMNS = ("customer_rating", "response_time_hours")


def load_reviews(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Read reviews, trim all text, find the review and sentiment columns by name, drop rows without a review.

    Quoted values may hold line breaks; pass `multiline=False` where none do, which saves one pass over the files.
    """
    raw = find_columns(read_text_table(spark, path, multiline))
    columns = []
    for name in raw.columns:
        column = strip(F.col(name))
        columns.append((column.try_cast("double") if name in NUMERIC_COLUMNS else column).alias(name))
    return raw.select(*columns).na.drop(subset=["review_text"])


def find_columns(df: DataFrame) -> DataFrame:
    """Rename the first column whose name holds a known fragment where the expected name is absent."""
    for wanted, fragments in REVIEW_COLUMNS.items():
        if wanted in df.columns:
            continue
        found = [name for name in df.columns if any(fragment in name for fragment in fragments)]
        if not found:
            raise ValueError(f"no column looks like {wanted}")
        df = df.withColumnRenamed(found[0], wanted)
    return df


def reviews_from_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Reviews out of documents; those without a label have no sentiment."""
    document, label = tables["documents"], tables["labels"].withColumn("labelled", F.lit(True))
    sentiment = F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").when(F.col("labelled"), "neutral")
    return document.join(label, "doc_id", "left").select(
        F.col("doc_id").alias("review_id"),
        F.col("text").alias("review_text"),
        sentiment.alias("sentiment"),
        (F.lit(1) + F.col("doc_id") % 5).cast("int").alias("customer_rating"),
        (F.col("n_chars") % 97).cast("double").alias("response_time_hours"),
        F.when(F.col("doc_id") % 3 == 0, "yes").otherwise("no").alias("issue_resolved"),
    )
