"""Complaint themes and service figures of reviews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import one_row
from tallyloom.functions.ranks import exact_quantiles
from tallyloom.session import stored

# Complaint themes by keyword, and the words left out of the complaint word ranking.
COMPLAINT_THEMES: dict[str, tuple[str, ...]] = {
    "Price Sensitivity": (
        "price", "expensive", "cost", "overpriced", "cheap", "afford",
        "discount", "refund", "value", "money", "fee", "charge", "billing",
    ),
    "Lack of Features": (
        "feature", "missing", "option", "functionality", "limited",
        "basic", "outdated", "upgrade", "version", "support", "integration",
        "capability", "unable",
    ),
    "Poor Service Quality": (
        "slow", "delay", "late", "rude", "unhelpful", "dissatisfied",
        "disappointed", "broken", "faulty", "poor", "bad", "terrible",
        "awful", "unacceptable", "complaint", "ignored", "wait", "hours",
    ),
}
COMPLAINT_STOPS = (
    "the", "and", "a", "to", "of", "in", "is", "it", "i", "was", "for", "my",
    "that", "this", "with", "but", "on", "at", "not", "have", "had", "be",
    "so", "we", "they", "you", "he", "she", "are", "an", "as", "by", "or",
    "its", "been", "no", "just", "were", "from", "me", "do", "your",
)
RESOLVED_VALUES = ("yes", "true", "1")


def theme_column(theme: str) -> str:
    return theme.lower().replace(" ", "_")


def negative_class(reviews: DataFrame, label: str = "sentiment"):
    """The first class in order whose name holds 'neg', else the first class, as a scalar."""
    name = F.lower(F.col(label))
    found = F.coalesce(F.min(F.when(F.contains(name, F.lit("neg")), name)), F.min(name))
    return reviews.agg(found.alias("c")).scalar()


def negative_reviews(reviews: DataFrame, label: str = "sentiment") -> DataFrame:
    """Reviews of the negative class."""
    return reviews.where(F.lower(F.col(label)) == negative_class(reviews, label))


def theme_flags(cleaned: DataFrame, themes: Mapping[str, Sequence[str]] = COMPLAINT_THEMES) -> DataFrame:
    """One flag per theme whose keywords occur as whole words, and `is_buyer_complaint` for any of them."""
    words = F.split("clean_review", " ")
    flags = [
        F.arrays_overlap(words, F.array(*[F.lit(k) for k in keywords])).alias(theme_column(theme))
        for theme, keywords in themes.items()
    ]
    flagged = cleaned.select("*", *flags)
    return flagged.withColumn("is_buyer_complaint", F.greatest(*[F.col(theme_column(t)) for t in [*themes, *themes]]))


def theme_breakdown(flagged: DataFrame, themes: Sequence[str] = tuple(COMPLAINT_THEMES)) -> DataFrame:
    """Reviews per theme and their share in percent; one pass."""
    rows = []
    for theme in themes:
        hits = F.count_if(theme_column(theme))
        share = 100.0 * hits / F.greatest(F.count("*"), F.lit(1))
        rows.append(F.struct(F.lit(theme).alias("theme"), hits.alias("reviews"), share.alias("share_pct")))
    return flagged.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))


def service_metrics(complaints: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean, median and 90th percentile response time, resolution rate, mean rating of complaints and of all reviews."""
    response = F.col("response_time_hours").try_cast("double")
    rating = F.avg(F.col("customer_rating").try_cast("double"))
    found = exact_quantiles(complaints.select(response.alias("v")), "v", [0.5, 0.9]).first()
    median, p90 = found["q"] if found else (None, None)
    resolved = F.coalesce(F.lower(F.col("issue_resolved")).isin(list(RESOLVED_VALUES)), F.lit(False))
    return complaints.agg(
        F.count("*").alias("complaints"),
        F.avg(response).alias("avg_response_hours"),
        (100.0 * F.avg(resolved.cast("double"))).alias("resolved_pct"),
        rating.alias("avg_rating_complaints"),
    ).select(
        "*",
        F.lit(median).cast("double").alias("median_response_hours"),
        F.lit(p90).cast("double").alias("p90_response_hours"),
        reviews.agg(rating.alias("r")).scalar().alias("avg_rating_all"),
    )


def value_share(df: DataFrame, column: str) -> DataFrame:
    """Share of each value in percent; a missing value is a value."""
    counts = df.groupBy(F.lower(F.col(column)).alias("value")).agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.select("value", "rows", (100.0 * F.col("rows") / total).alias("share_pct"))


def sentiment_counts(reviews: DataFrame, label: str = "sentiment") -> DataFrame:
    """Reviews per sentiment, most frequent first."""
    counts = reviews.where(F.col(label).isNotNull()).groupBy(F.lower(F.col(label)).alias("sentiment"))
    return counts.agg(F.count("*").alias("reviews")).orderBy(F.col("reviews").desc(), "sentiment")


def rating_histogram(df: DataFrame, column: str = "customer_rating", bins: int = 5) -> DataFrame:
    """Equal-width bins between least and greatest value; the last bin includes the greatest.

    One pass finds the ends, another counts all bins, empty ones too.
    """
    value = F.col(column).try_cast("double")
    ends = one_row(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    flat = F.when(F.col("_e.lo") == F.col("_e.hi"), 0.5).otherwise(0.0)
    rows = df.select(value.alias("_v"), ends.alias("_e")).select(
        "_v", (F.col("_e.lo") - flat).alias("_lo"), (F.col("_e.hi") + flat).alias("_hi")
    )
    at = F.least(F.floor((F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))
    step = (F.max("_hi") - F.max("_lo")) / bins
    slots = [
        F.struct(
            F.lit(i + 1).alias("bin"),
            (F.max("_lo") + i * step).alias("low"),
            (F.max("_lo") + (i + 1) * step).alias("high"),
            F.count_if(at == i).alias("reviews"),
        )
        for i in range(bins)
    ]
    return rows.agg(F.array(*slots).alias("_s")).select(F.inline("_s"))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: quartiles, whiskers (furthest values within 1.5 interquartile ranges) and outliers."""
    rows = df.select(F.col(group).alias("_g"), F.col(value).try_cast("double").alias("_v")).na.drop()
    quartiles = exact_quantiles(rows, "_v", [0.25, 0.5, 0.75], ["_g"])
    fenced = stored(quartiles, "quartiles").select(
        "_g",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        (1.5 * (F.col("q")[2] - F.col("q")[0])).alias("_reach"),
    )
    within = F.col("_v").between(F.col("q1") - F.col("_reach"), F.col("q3") + F.col("_reach"))
    return (
        rows.join(fenced, "_g")
        .groupBy(F.col("_g").alias(group), "q1", "median", "q3")
        .agg(
            F.min(F.when(within, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(within, F.col("_v"))).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
            F.count("*").alias("rows"),
        )
    )


def negative_response_mean(reviews: DataFrame) -> DataFrame:
    """Mean response time of negative reviews."""
    mean = F.avg(F.col("response_time_hours").try_cast("double")).alias("avg_response_hours")
    return negative_reviews(reviews).agg(mean)
