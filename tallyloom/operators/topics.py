"""Topics of reviews and figures per topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.text import COMPETITOR_SEEDS, PAIN_POINT_SEEDS
from tallyloom.operators.topic_model import TopicModel, document_topics, fit, shares

# Topics, words shown per topic, passes over the reviews.
TOPICS, TOP_WORDS, PASSES = 8, 12, 15


def fit_topics(
    tokenised: DataFrame, k: int = TOPICS, passes: int = PASSES, seed: int = 42, min_documents: int = 3, max_share: float = 0.6
) -> TopicModel:
    """Topics of tokenised reviews; the priors of topics in documents and of words in topics are both learned."""
    return fit(tokenised, k, passes, seed, min_documents, max_share)


def topic_words(model: TopicModel, top: int = TOP_WORDS) -> DataFrame:
    """The words of each topic with their weights and the topic's label; topics times words rows, ties in word order."""
    order = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), "term")
    ranked = shares(model).withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < top)
    words = ranked.select("topic_id", "place", F.col("term").alias("keyword"), "weight")
    return words.join(topic_labels(words), "topic_id").select("topic_id", "label", "place", "keyword", "weight")


def topic_labels(
    words: DataFrame, competitor: Sequence[str] = COMPETITOR_SEEDS, pain: Sequence[str] = PAIN_POINT_SEEDS
) -> DataFrame:
    """Label of each topic from the seed terms among its words; up to three are shown, in order."""
    own = F.array_sort(F.collect_set("keyword"))  # a dozen words
    named = words.groupBy("topic_id").agg(own.alias("_w"))
    in_set = lambda seeds: F.filter("_w", lambda w: w.isin(list(seeds)))
    shown = lambda hits: F.concat(F.lit(" ["), F.concat_ws(", ", F.slice(hits, 1, 3)), F.lit("]"))
    hits = named.select("topic_id", in_set(competitor).alias("c"), in_set(pain).alias("p"))
    competes, pains = F.size("c") > 0, F.size("p") > 0
    label = (
        F.when(competes & pains, F.concat(F.lit("Competitor Pain"), shown("c")))
        .when(competes, F.concat(F.lit("Competitor/Alt"), shown("c")))
        .when(pains, F.concat(F.lit("Pain Point"), shown("p")))
        .otherwise("General Feedback")
    )
    return hits.select("topic_id", label.alias("label"))


def dominant_topic(model: TopicModel, labels: DataFrame) -> DataFrame:
    """The most probable topic of each review, its probability and its label."""
    best = F.array_max("topics")
    assigned = document_topics(model)
    placed = assigned.select(
        *[c for c in assigned.columns if c != "topics"],
        (F.array_position("topics", best) - 1).cast("int").alias("dominant_topic"),
        F.round(best, 4).alias("topic_probability"),
    )
    names = labels.select(F.col("topic_id").alias("dominant_topic"), F.col("label").alias("topic_label"))
    return placed.join(F.broadcast(names), "dominant_topic", "left")  # one row per topic


def topic_counts(assigned: DataFrame, k: int) -> DataFrame:
    """Reviews per topic, 0 for a topic without any."""
    slots = [
        F.struct(F.lit(i).alias("topic"), F.count_if(F.col("dominant_topic") == i).alias("reviews")) for i in range(k)
    ]
    return assigned.agg(F.array(*slots).alias("_s")).select(F.inline("_s"))


def topic_sentiment_pivot(assigned: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Topic by sentiment counts, 0 where absent."""
    counts = [F.count_if(F.lower(F.col("sentiment")) == c).alias(c) for c in classes]
    return assigned.groupBy("dominant_topic").agg(*counts)


def topic_mean_rating(assigned: DataFrame, low: float = 3.0) -> DataFrame:
    """Mean rating per topic, flagged below `low`."""
    mean = assigned.groupBy("dominant_topic").agg(F.avg(F.col("customer_rating").try_cast("double")).alias("avg_rating"))
    return mean.withColumn("is_low", F.col("avg_rating") < low)
